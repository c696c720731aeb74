"""Qualified names of everything that is not a path. Case rules differ per kind on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.settings import JobSettings

# Type names.
SPARK_DB = "spark_db"
SPARK_TABLE = "spark_table"
SPARK_STORAGE = "spark_storagedesc"
SPARK_PROCESS = "spark_process"
ML_DIRECTORY = "spark_ml_directory"
ML_PIPELINE = "spark_ml_pipeline"
ML_MODEL = "spark_ml_model"
HBASE_TABLE = "hbase_table"
KAFKA_TOPIC = "kafka_topic"
RDBMS_TABLE = "rdbms_table"
HIVE_TABLE = "hive_table"

# Catalog settings as Spark and Hive name them.
CATALOG_IMPLEMENTATION = "spark.sql.catalogImplementation"
METASTORE_URIS = "hive.metastore.uris"
CONNECTION_DRIVER = "javax.jdo.option.ConnectionDriverName"
CONNECTION_URL = "javax.jdo.option.ConnectionURL"
EMBEDDED_DERBY = "org.apache.derby.jdbc.EmbeddedDriver"


def hbase_name(cluster: Column, namespace: Column, table: Column) -> Column:
    """``namespace:table@cluster``; a ``ns:`` before the table is cut, any null part gives null."""
    low = F.lower(table)
    bare = F.when(low.contains(":"), F.regexp_replace(low, "^[^:]*:", "")).otherwise(low)
    return F.concat(F.lower(namespace), F.lit(":"), bare, F.lit("@"), cluster)


def kafka_name(topic: Column, cluster: Column) -> Column:
    """``topic@cluster``; only the topic is lower-cased."""
    return F.concat(F.lower(topic), F.lit("@"), cluster)


def hive_name(db: Column, table: Column, cluster: Column) -> Column:
    return F.concat(F.lower(db), F.lit("."), F.lower(table), F.lit("@"), cluster)


def identifier(name: Column, settings: JobSettings = JobSettings()) -> Column:
    """Table or database identifier as the session's analyser compares it."""
    return name if settings.case_sensitive else F.lower(name)


def database_identifier(db: Column, settings: JobSettings = JobSettings()) -> Column:
    return identifier(F.coalesce(db, F.lit(settings.current_db)), settings)


def _filled(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(F.length(trimmed) > 0, trimmed)


def is_remote(implementation: Column, metastore_uris: Column) -> Column:
    """True when a Hive catalog is served by a remote metastore."""
    return F.coalesce((implementation == "hive") & _filled(metastore_uris).isNotNull(), F.lit(False))


def catalog_prefix(
    app_id: Column, implementation: Column, metastore_uris: Column, driver: Column, connection_url: Column
) -> Column:
    """What makes a database name unique: the application, the metastore, or the metastore's own database."""
    own = F.coalesce(implementation, F.lit("in-memory")) != "hive"
    embedded = F.coalesce(driver, F.lit("")) == EMBEDDED_DERBY
    holder = (
        F.when(own, app_id)
        .when(_filled(metastore_uris).isNotNull(), F.trim(metastore_uris))
        .when(embedded, app_id)
        .otherwise(F.coalesce(connection_url, F.lit("null")))
    )
    return F.concat(holder, F.lit("."))


def db_name(prefix: Column, db: Column) -> Column:
    return F.concat(prefix, db)


def table_name(prefix: Column, db: Column, table: Column) -> Column:
    return F.concat(prefix, db, F.lit("."), table)


def storage_name(prefix: Column, db: Column, table: Column) -> Column:
    return F.concat(prefix, db, F.lit("."), table, F.lit(".storageFormat"))


def model_uid(uid: Column) -> Column:
    return F.replace(uid, F.lit("pipeline"), F.lit("model"))


def process_name(app_name: Column, app_id: Column) -> Column:
    shell = F.concat(F.lit("Spark Job + "), app_id)
    return F.when(app_name == "Spark shell", shell).otherwise(F.concat(app_name, F.lit(" "), app_id))
