"""Dataset identity of connector reads and writes, from the options a job gave its connector.

Input: ``scan_options(app_id, execution_id, direction, connector, options)``. Output rows keep the
key columns and add ``type_name, qualified_name, name, cluster, uri``; options that cannot be read
go to ``rejected`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import jdbc, names, pushed
from weftline.functions import plan_text as pt
from weftline.settings import JobSettings

# Option keys that decide an identity.
CLUSTER_OPTION = "atlas.cluster.name"
KAFKA_CLUSTER_OPTION = "kafka.atlas.cluster.name"

# The class-name endings that tell a connector.
CONNECTOR_CLASSES = {
    "hbase": ["execution.datasources.hbase.HBaseRelation", "execution.datasources.hbase.DefaultSource"],
    "hwc": [
        "hive.llap.HiveWarehouseConnector",
        "hive.llap.HiveWarehouseDataSourceWriter",
        "hive.llap.HiveStreamingDataSourceWriter",
        "hive.llap.streaming.HiveStreamingDataSourceWriter",
    ],
    "kafka": ["kafka010.KafkaRelation", "kafka010.KafkaSourceProvider", "kafka010.KafkaSourceRDD"],
    "jdbc": ["datasources.jdbc.JDBCRelation", "datasources.jdbc.JdbcRelationProvider"],
}


def connector_of(class_name: Column) -> Column:
    """Connector whose relation, provider or writer class this is; null for any other class."""
    found = F.lit(None).cast("string")
    for connector, endings in CONNECTOR_CLASSES.items():
        hit = F.lit(False)
        for ending in endings:
            hit = hit | class_name.endswith(ending)
        found = F.coalesce(found, F.when(hit, connector))
    return found


def _option(key: str) -> Column:
    return F.col("options")[key]


def _one(type_name: str, name: Column, qualified: Column, cluster: Column, uri: Column) -> Column:
    return F.struct(
        F.lit(type_name).alias("type_name"),
        qualified.alias("qualified_name"),
        name.alias("name"),
        cluster.cast("string").alias("cluster"),
        uri.cast("string").alias("uri"),
    )


def _nothing() -> Column:
    return F.array().cast("array<struct<type_name:string,qualified_name:string,name:string,cluster:string,uri:string>>")


def _hbase(settings: JobSettings) -> Column:
    catalog = _option("catalog")
    namespace = F.coalesce(F.get_json_object(catalog, "$.table.namespace"), F.lit("default"))
    table = F.get_json_object(catalog, "$.table.name")
    cluster = F.coalesce(_option(CLUSTER_OPTION), F.lit(settings.cluster))
    uri = F.concat(F.lower(namespace), F.lit(":"), F.lower(table))
    one = _one(names.HBASE_TABLE, F.lower(table), names.hbase_name(cluster, namespace, table), cluster, uri)
    return F.when(F.coalesce(catalog, F.lit("")) != "", F.array(one)).otherwise(_nothing())


def _jdbc(settings: JobSettings) -> Column:
    url = F.coalesce(_option("url"), F.lit(""))
    table = F.coalesce(_option("dbtable"), F.lit(""))
    nothing = F.lit(None)
    return F.array(_one(names.RDBMS_TABLE, table, jdbc.rdbms_name(url, table), nothing, nothing))


def assigned_topics(assign: Column) -> Column:
    """Topics of ``{"topic":[partitions]}``; null when the text has another shape."""
    parsed = F.from_json(assign, "map<string,array<int>>")
    whole = F.forall(F.map_values(parsed), lambda parts: parts.isNotNull())
    return F.when(parsed.isNotNull() & whole, F.map_keys(parsed))


def read_topics() -> Column:
    """Topics a Kafka read names: a list, else an assignment, else (a pattern) none."""
    listed = F.split(F.regexp_replace(_option("subscribe"), ",+$", ""), ",")
    return (
        F.when(_option("subscribe").isNotNull(), F.array_distinct(listed))
        .when(_option("assign").isNotNull(), assigned_topics(_option("assign")))
        .otherwise(F.array().cast("array<string>"))
    )


def _kafka(settings: JobSettings) -> Column:
    # Streams name the cluster in their consumer or producer settings, without the ``kafka.`` prefix.
    cluster = F.coalesce(_option(KAFKA_CLUSTER_OPTION), _option(CLUSTER_OPTION), F.lit(settings.cluster))
    written = F.when(_option("topic").isNotNull(), F.array(_option("topic"))).otherwise(F.array().cast("array<string>"))
    topics = F.when(F.col("direction") == "output", written).otherwise(read_topics())
    return F.transform(
        topics,
        lambda t: _one(names.KAFKA_TOPIC, F.lower(t), names.kafka_name(t, cluster), cluster, F.lower(t)),
    )


def _hwc(settings: JobSettings) -> Column:
    default_db = F.coalesce(_option("default.db"), F.lit("default"))
    # Of a pushed-down query only the first table counts.
    target = F.coalesce(F.get(pushed.tables(_option("query")), 0), F.lit(""))
    named = F.coalesce(_option("table"), F.lit(""))
    text = F.when(_option("query").isNotNull(), target).otherwise(named)
    parts = F.split(F.regexp_replace(text, r"\.+$", ""), r"\.")
    db = (
        F.when(_option("db").isNotNull(), _option("db"))
        .when(F.size(parts) == 2, F.try_element_at(parts, F.lit(1)))
        .otherwise(default_db)
    )
    table = F.when(_option("db").isNull() & (F.size(parts) == 2), F.try_element_at(parts, F.lit(2))).otherwise(text)
    cluster = F.lit(settings.cluster)
    one = _one(names.HIVE_TABLE, F.lower(table), names.hive_name(db, table, cluster), F.lit(None), F.lit(None))
    too_long = _option("db").isNull() & (F.size(parts) > 2)
    no_table = _option("query").isNotNull() & (target == "")
    return F.when(no_table, _nothing()).when(~too_long, F.array(one))


def identities(options: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """``found``: array of identities per options row; null means the options are wrong, empty means none.

    ``connector`` is a short name, or the name of a relation, provider or writer class."""
    options = options.withColumn("connector", F.coalesce(connector_of(F.col("connector")), F.col("connector")))
    kind = F.col("connector")
    found = (
        F.when(kind == "hbase", _hbase(settings))
        .when(kind == "jdbc", _jdbc(settings))
        .when(kind == "kafka", _kafka(settings))
        .when(kind == "hwc", _hwc(settings))
        .otherwise(_nothing())
    )
    return options.withColumn("found", found)


def datasets(options: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """One row per dataset a connector reads or writes; ``nth`` is its place among those of its options."""
    keys = ["app_id", "execution_id", "direction", "connector"]
    # The outer form, because for the inner one Spark infers a filter on the array and would work it out again in it.
    listed = identities(options, settings).select(*keys, F.posexplode_outer("found").alias("nth", "dataset"))
    return listed.select(*keys, "nth", "dataset.*").where("qualified_name is not null")


def without_options(leaves: DataFrame, chosen: DataFrame, options: DataFrame) -> DataFrame:
    """Connector leaves of harvested statements that no options row speaks for, as bad records."""
    reads = leaves.where("kind = 'connector'").join(chosen.select("root_execution_id", "app_id", "tag").distinct(), ["root_execution_id", "app_id", "tag"], "left_semi")
    known = options.where("direction = 'input'").select("app_id", F.col("execution_id").alias("known_id")).distinct()
    read, given = reads.alias("r"), known.alias("k")
    own = (F.col("r.execution_id") == F.col("k.known_id")) & (F.col("r.app_id") == F.col("k.app_id"))
    root = (F.col("r.root_execution_id") == F.col("k.known_id")) & (F.col("r.app_id") == F.col("k.app_id"))
    bare = read.join(given, own, "left_anti").alias("r").join(given, root, "left_anti")
    return bare.select("app_id", "execution_id", F.lit("connector without options").alias("reason"), F.col("node").alias("detail"))


def unmatched_writers(chosen: DataFrame, options: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Saves and writers of harvested statements whose target no connector names, as bad records; their statements have inputs only.

    Options of another connector, or none at all, name no target. Options that cannot be read are in ``rejected``."""
    command = F.col("command")
    writers = chosen.where(command.isin(pt.SAVE_SOURCE, "WriteToDataSourceV2")).select("app_id", "execution_id", "command_pos", "command", "arguments")
    named = datasets(options, settings).where("direction = 'output'").select("app_id", "execution_id").distinct()
    bare = writers.join(named, ["execution_id", "app_id"], "left_anti")
    return bare.select("app_id", "execution_id", F.lit("unmatched writer").alias("reason"), F.concat_ws(" ", command, F.col("arguments")).alias("detail"))


def rejected(options: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Options no identity can be built from, as bad records."""
    broken = F.col("found").isNull() | F.exists("found", lambda d: d["qualified_name"].isNull())
    return (
        identities(options, settings)
        .where(broken)
        .select(
            "app_id",
            "execution_id",
            F.concat(F.lit("unreadable options of "), "connector").alias("reason"),
            F.to_json("options").alias("detail"),
        )
    )
