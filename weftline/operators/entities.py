"""Entity rows from definitions and names.

An entity row is ``type_name, qualified_name, name, attrs, is_reference, create_rank`` plus ``deps``
(what must exist first) and ``rels`` (links by name). Both are short arrays, so a definition becomes
all its entities in one pass; ``dependencies`` and ``relationships`` unfold them to tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import names, paths
from weftline.settings import JobSettings

REF = "array<struct<type_name:string,qualified_name:string>>"
RELS = "array<struct<rel:string,type_name:string,qualified_name:string>>"

# Who must be created before whom. A higher rank depends only on lower ones.
CREATE_RANK = {
    paths.FS_PATH: 0,
    paths.HDFS_PATH: 0,
    paths.S3_BUCKET: 0,
    paths.S3_PSEUDO_DIR: 1,
    paths.S3_OBJECT: 2,
    names.HBASE_TABLE: 0,
    names.KAFKA_TOPIC: 0,
    names.RDBMS_TABLE: 0,
    names.HIVE_TABLE: 0,
    names.SPARK_DB: 0,
    names.SPARK_STORAGE: 0,
    names.SPARK_TABLE: 1,
    names.ML_DIRECTORY: 0,
    names.ML_PIPELINE: 3,
    names.ML_MODEL: 3,
    names.SPARK_PROCESS: 4,
}


def create_rank(type_name: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in CREATE_RANK.items() for x in pair])
    return ranks[type_name]


def attributes(**values: Column) -> Column:
    """Attribute bag; what is null is simply not set."""
    keys = F.array(*[F.lit(k) for k in values])
    texts = F.array(*[v.cast("string") for v in values.values()])
    return F.map_filter(F.map_from_arrays(keys, texts), lambda _, v: v.isNotNull())


def entity(
    type_name: str,
    qualified_name: Column,
    name: Column,
    attrs: Column,
    deps: Column | None = None,
    rels: Column | None = None,
    is_reference: bool = False,
) -> Column:
    return F.struct(
        F.lit(type_name).alias("type_name"),
        qualified_name.alias("qualified_name"),
        name.cast("string").alias("name"),
        attrs.alias("attrs"),
        F.lit(is_reference).alias("is_reference"),
        F.lit(CREATE_RANK[type_name]).alias("create_rank"),
        (F.array() if deps is None else deps).cast(REF).alias("deps"),
        (F.array() if rels is None else rels).cast(RELS).alias("rels"),
    )


def ref(type_name: str, qualified_name: Column) -> Column:
    return F.struct(F.lit(type_name).alias("type_name"), qualified_name.alias("qualified_name"))


def rel(name: str, type_name: str, qualified_name: Column) -> Column:
    return F.struct(
        F.lit(name).alias("rel"), F.lit(type_name).alias("type_name"), qualified_name.alias("qualified_name")
    )


def plain_definitions(frame: DataFrame) -> DataFrame:
    """Definitions with their maps as JSON text: maps cannot be compared, and attributes are text anyway."""
    for name, kind in frame.dtypes:
        if kind.startswith("map"):
            frame = frame.withColumn(name, F.to_json(name))
    return frame


def db_entity(prefix: Column, db: Column, d: Column, owner: Column, settings: JobSettings) -> Column:
    """Database entity of a plain definition struct ``d(description, location, parameters)``."""
    return entity(
        names.SPARK_DB,
        names.db_name(prefix, db),
        db,
        attributes(
            clusterName=F.lit(settings.cluster),
            description=d["description"],
            location=d["location"],
            parameters=d["parameters"],
            owner=owner,
            ownerType=F.lit("USER"),
        ),
    )


def storage_entity(prefix: Column, db: Column, table: Column, t: Column) -> Column:
    """Storage entity of a table definition struct; absent optional attributes are not set."""
    return entity(
        names.SPARK_STORAGE,
        names.storage_name(prefix, db, table),
        F.lit(None),
        attributes(
            location=t["location"],
            inputFormat=t["input_format"],
            outputFormat=t["output_format"],
            serde=t["serde"],
            compressed=t["compressed"],
            parameters=t["storage_parameters"],
        ),
    )


def table_entity(prefix: Column, db: Column, table: Column, t: Column, with_deps: bool = True) -> Column:
    """Table entity with its links to database and storage; the alter form has no dependencies."""
    owner_db = ref(names.SPARK_DB, names.db_name(prefix, db))
    storage = ref(names.SPARK_STORAGE, names.storage_name(prefix, db, table))
    created = F.date_format(F.timestamp_millis(t["create_time"]), "yyyy-MM-dd HH:mm:ss")
    return entity(
        names.SPARK_TABLE,
        names.table_name(prefix, db, table),
        table,
        attributes(
            tableType=t["table_type"],
            schemaDesc=t["schema_desc"],
            provider=F.coalesce(t["provider"], F.lit("")),
            partitionProvider=F.when(t["tracks_partitions"], "Catalog"),
            partitionColumnNames=F.to_json(t["partition_columns"]),
            bucketSpec=t["bucket_spec"],
            owner=t["owner"],
            ownerType=F.lit("USER"),
            createTime=created,
            parameters=t["parameters"],
            comment=t["comment"],
            unsupportedFeatures=F.to_json(t["unsupported_features"]),
        ),
        deps=F.array(owner_db, storage) if with_deps else None,
        rels=F.array(
            rel("db", names.SPARK_DB, names.db_name(prefix, db)),
            rel("sd", names.SPARK_STORAGE, names.storage_name(prefix, db, table)),
        ),
    )


def hive_reference(db: Column, table: Column, settings: JobSettings) -> Column:
    return entity(
        names.HIVE_TABLE,
        names.hive_name(db, table, F.lit(settings.cluster)),
        table,
        attributes(none=F.lit(None)),
        is_reference=True,
    )


def table_graph(definitions: DataFrame, settings: JobSettings = JobSettings(), with_deps: bool = True) -> DataFrame:
    """All entities of tables: own tables give database, storage and table, remote ones a reference.

    ``definitions`` has ``prefix, remote_hms`` and the plain structs ``t`` (table) and ``d`` (its database).
    """
    prefix, t, d = F.col("prefix"), F.col("t"), F.col("d")
    db = names.database_identifier(t["db"], settings)
    table = names.identifier(t["name"], settings)
    full = F.array(
        db_entity(prefix, db, d, t["owner"], settings),
        storage_entity(prefix, db, table, t),
        table_entity(prefix, db, table, t),
    )
    altered = F.array(table_entity(prefix, db, table, t, with_deps=False))
    own = full if with_deps else altered
    rows = F.when(F.col("remote_hms"), F.array(hive_reference(db, table, settings))).otherwise(own)
    return definitions.select(F.inline(rows))


def refreshed(event_definition: Column, catalog_definition: Column) -> Column:
    """The catalog's definition when it has one, else the one the event carried."""
    return F.coalesce(catalog_definition, event_definition)


def path_entities(uri: Column, plain: Column) -> Column:
    """Entities of a path: one, or for an S3 object the chain object, directory, bucket."""
    bucket, folder, thing = paths.s3_bucket_name(uri), paths.s3_dir(plain), paths.s3_object(plain)
    folder_name = F.concat(bucket, folder)
    s3 = F.array(
        entity(paths.S3_BUCKET, bucket, paths.authority(uri), attributes(none=F.lit(None))),
        entity(
            paths.S3_PSEUDO_DIR,
            folder_name,
            folder,
            attributes(objectPrefix=folder_name),
            deps=F.array(ref(paths.S3_BUCKET, bucket)),
            rels=F.array(rel("bucket", paths.S3_BUCKET, bucket)),
        ),
        entity(
            paths.S3_OBJECT,
            F.concat(folder_name, thing),
            thing,
            attributes(path=plain),
            deps=F.array(ref(paths.S3_PSEUDO_DIR, folder_name)),
            rels=F.array(rel("pseudoDirectory", paths.S3_PSEUDO_DIR, folder_name)),
        ),
    )
    low = F.lower(plain)
    hdfs = entity(paths.HDFS_PATH, uri, low, attributes(path=low, clusterName=paths.authority(uri)))
    other = entity(paths.FS_PATH, uri, low, attributes(path=low))
    return F.when(paths.is_s3(uri), s3).when(paths.scheme(uri) == "hdfs", F.array(hdfs)).otherwise(F.array(other))


def path_graph(frame: DataFrame, path: str, settings: JobSettings = JobSettings()) -> DataFrame:
    """Entities of a column of paths."""
    resolved = paths.with_plain(frame.select(paths.resolve(F.col(path), settings).alias("uri")))
    return resolved.select(F.inline(path_entities(F.col("uri"), F.col("plain"))))


def connector_graph(found: DataFrame) -> DataFrame:
    """Entities of ``connectors.datasets`` rows; Hive tables reached through a connector are references."""
    attrs = attributes(
        clusterName=F.col("cluster"),
        uri=F.col("uri"),
        topic=F.when(F.col("type_name") == names.KAFKA_TOPIC, F.col("uri")),
    )
    return found.select(
        "type_name",
        "qualified_name",
        "name",
        attrs.alias("attrs"),
        (F.col("type_name") == names.HIVE_TABLE).alias("is_reference"),
        create_rank(F.col("type_name")).alias("create_rank"),
        F.array().cast(REF).alias("deps"),
        F.array().cast(RELS).alias("rels"),
    )


def ml_directory(uri: Column, directory: Column) -> Column:
    name = F.concat(uri, F.lit("."), directory)
    return entity(names.ML_DIRECTORY, name, name, attributes(uri=uri, directory=directory))


def ml_entity(type_name: str, uid: Column, directory_type: Column, directory_name: Column) -> Column:
    """Pipeline or model with its directory as dependency and link."""
    qualified = names.model_uid(uid) if type_name == names.ML_MODEL else uid
    where = F.struct(directory_type.alias("type_name"), directory_name.alias("qualified_name"))
    link = F.struct(
        F.lit("directory").alias("rel"), directory_type.alias("type_name"), directory_name.alias("qualified_name")
    )
    return entity(
        type_name, qualified, qualified, attributes(none=F.lit(None)), deps=F.array(where), rels=F.array(link)
    )


def dependencies(graph: DataFrame) -> DataFrame:
    exploded = graph.where("not is_reference").select("type_name", "qualified_name", F.explode("deps").alias("dep"))
    return exploded.select(
        "type_name",
        "qualified_name",
        F.col("dep.type_name").alias("dep_type_name"),
        F.col("dep.qualified_name").alias("dep_qualified_name"),
    )


def relationships(graph: DataFrame) -> DataFrame:
    exploded = graph.select("type_name", "qualified_name", F.explode("rels").alias("link"))
    return exploded.select(
        F.col("type_name").alias("from_type"),
        F.col("qualified_name").alias("from_qn"),
        F.col("link.rel").alias("rel"),
        F.col("link.type_name").alias("to_type"),
        F.col("link.qualified_name").alias("to_qn"),
    )


def first_of_each(rows: DataFrame, order: str) -> DataFrame:
    """One row per ``(type_name, qualified_name)``, the first by ``order``.

    An aggregate rather than a window: copies of a very common entity are combined before the shuffle.
    """
    rest = [c for c in rows.columns if c not in ("type_name", "qualified_name")]
    kept = F.min_by(F.struct(*rest), F.col(order)).alias("kept")
    return rows.groupBy("type_name", "qualified_name").agg(kept).select("type_name", "qualified_name", "kept.*")


def attribute_rows(graph: DataFrame, *keep: str) -> DataFrame:
    """Attributes unfolded to one row each."""
    return graph.select(*keep, "type_name", "qualified_name", F.explode("attrs").alias("attr", "value"))
