"""Path resolution and the dataset identity of a path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.settings import JobSettings

# Type names of path datasets.
FS_PATH = "fs_path"
HDFS_PATH = "hdfs_path"
S3_OBJECT = "aws_s3_object"
S3_PSEUDO_DIR = "aws_s3_pseudo_dir"
S3_BUCKET = "aws_s3_bucket"

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^[^:/?#]+://([^/?#]*)"
_RAW_PATH = r"^[^:/?#]+:(?://[^/?#]*)?([^?#]*)"


def scheme(uri: Column) -> Column:
    return F.regexp_extract(uri, _SCHEME, 1)


def authority(uri: Column) -> Column:
    return F.regexp_extract(uri, _AUTHORITY, 1)


def _tidy(path: Column) -> Column:
    """One slash between segments and none at the end (the root stays ``/``)."""
    return F.regexp_replace(F.regexp_replace(path, "/{2,}", "/"), "(?<=.)/$", "")


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments; only paths that have some pay for the fold."""
    folded = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when((part == "..") & (F.size(done) > 1), F.slice(done, 1, F.size(done) - 1))
        .otherwise(F.array_append(done, part)),
    )
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), F.array_join(folded, "/")).otherwise(path)


def _decoded(path: Column) -> Column:
    """Undo percent escapes. A plus sign is a plain character in a path."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def plain_path(uri: Column) -> Column:
    """Path of a URI without scheme, authority, query and fragment.

    The functions below take it as ``plain``. Put it in a column of its own first (``with_plain``),
    so that it is worked out once per row however many of them use it.
    """
    return _tidy(_decoded(_without_dots(F.regexp_extract(uri, _RAW_PATH, 1))))


def with_plain(frame: DataFrame, uri: str = "uri", plain: str = "plain") -> DataFrame:
    return frame.withColumn(plain, plain_path(F.col(uri)))


def resolve(path: Column, settings: JobSettings = JobSettings()) -> Column:
    """Full URI of ``path``: unchanged if it names a scheme, else placed on the default filesystem.

    Without a scheme the whole text is a path, so ``%``, ``#`` and ``?`` are escaped.
    """
    base = settings.working_dir.rstrip("/")
    absolute = _tidy(F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(base + "/"), path)))
    escaped = absolute
    for char, code in (("%", "%25"), ("#", "%23"), ("?", "%3F")):
        escaped = F.replace(escaped, F.lit(char), F.lit(code))
    root = "file:" if settings.default_fs.startswith("file:") else settings.default_fs.rstrip("/")
    return F.when(path.rlike(_SCHEME), path).otherwise(F.concat(F.lit(root), escaped))


def is_s3(uri: Column) -> Column:
    return scheme(uri).isin("s3", "s3a", "s3n")


def path_type(uri: Column) -> Column:
    return F.when(scheme(uri) == "hdfs", HDFS_PATH).when(is_s3(uri), S3_OBJECT).otherwise(FS_PATH)


def s3_bucket_name(uri: Column) -> Column:
    return F.concat(F.lit("s3://"), authority(uri))


def s3_dir(plain: Column) -> Column:
    return F.regexp_replace(plain, "[^/]*$", "")


def s3_object(plain: Column) -> Column:
    return F.substring_index(plain, "/", -1)


def path_qualified_name(uri: Column, plain: Column) -> Column:
    """S3 objects are named ``s3://bucket/dir/object`` whatever the input scheme; other URIs keep their text."""
    return F.when(is_s3(uri), F.concat(s3_bucket_name(uri), plain)).otherwise(uri)


def path_name(uri: Column, plain: Column) -> Column:
    return F.when(is_s3(uri), s3_object(plain)).otherwise(F.lower(plain))


def path_attr(uri: Column, plain: Column) -> Column:
    return F.when(is_s3(uri), plain).otherwise(F.lower(plain))


def path_cluster(uri: Column) -> Column:
    """The authority of HDFS paths; other paths carry no cluster."""
    return F.when(scheme(uri) == "hdfs", authority(uri))
