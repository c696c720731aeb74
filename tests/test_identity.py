"""Identity functions on the known cases."""

import pytest
from pyspark.sql import functions as F

from weftline.functions import jdbc, names, paths
from weftline.operators import connectors, entities
from weftline.settings import JobSettings

# The address forms the drivers document. Hosts, databases and parameters are our own.
URLS = {
    "jdbc:mysql://db-a.test:3307/Ledger": "Ledger",
    "jdbc:mysql://[fd00::7]:3306/ledger?useSSL=true": "ledger",
    "jdbc:mysql://db-a.test/": "",
    "jdbc:mariadb://db-b.test/ledger?x=/y": "ledger",
    "jdbc:db2://10.2.0.9:446/WARE": "WARE",
    "jdbc:derby:memory:scratch;create=true": "scratch",
    "jdbc:derby://db-c.test:1527/scratch;user=me": "scratch",
    "jdbc:oracle:thin:me/pw@db-d.test:1599:ORA9": "ORA9",
    "jdbc:postgresql://db-e.test:6543/facts?ssl=true": "facts",
    "jdbc:sqlserver://db-f.test;databaseName=Mart;encrypt=true;": "Mart",
    "jdbc:sqlserver://db-f.test:1444": "",
    "jdbc:teradata://db-g.test/DATABASE=mart/TMODE=ANSI": "mart",
    "jdbc:teradata://db-g.test": "",
    "jdbc:h2:mem:unknown-dialect": "",
}


def test_jdbc_database(spark):
    frame = spark.createDataFrame([(u,) for u in URLS], "url string")
    got = {r.url: r.db for r in frame.select("url", jdbc.database_name(F.col("url")).alias("db")).collect()}
    assert got == URLS


def test_rdbms_name_ignores_host(spark):
    row = spark.sql("select 'jdbc:mysql://One.test:1/Ledger' u, 'Entry' t")
    assert row.select(jdbc.rdbms_name(F.col("u"), F.col("t"))).first()[0] == "ledger.entry"


PATHS = [
    # path, type, qualified name, name
    ("hdfs://nn:8020/Data/A%20b/", "hdfs_path", "hdfs://nn:8020/Data/A%20b/", "/data/a b"),
    ("file:///tmp/Some//File", "fs_path", "file:///tmp/Some//File", "/tmp/some/file"),
    ("s3://lake-1/raw/day=3/part.orc", "aws_s3_object", "s3://lake-1/raw/day=3/part.orc", "part.orc"),
    ("s3a://B/Top", "aws_s3_object", "s3://B/Top", "Top"),
    ("s3n://b/x/../y/./z?v=1#f", "aws_s3_object", "s3://b/y/z", "z"),
    ("S3://b/x", "fs_path", "S3://b/x", "/x"),
    ("hdfs://nn/a+b", "hdfs_path", "hdfs://nn/a+b", "/a+b"),
]


def test_path_identity(spark):
    frame = paths.with_plain(spark.createDataFrame([(p[0],) for p in PATHS], "uri string"))
    uri, plain = F.col("uri"), F.col("plain")
    got = frame.select(
        "uri", paths.path_type(uri), paths.path_qualified_name(uri, plain), paths.path_name(uri, plain)
    ).collect()
    assert sorted(map(tuple, got)) == sorted(PATHS)


@pytest.mark.parametrize(
    "path, settings, expected",
    [
        ("/a/b/", JobSettings(default_fs="hdfs://nn:8020"), "hdfs://nn:8020/a/b"),
        ("x y", JobSettings(default_fs="hdfs://nn:8020", working_dir="/user/u/"), "hdfs://nn:8020/user/u/x y"),
        ("/a", JobSettings(), "file:/a"),
        ("/a#b?c%d", JobSettings(), "file:/a%23b%3Fc%25d"),
        ("s3a://b/k", JobSettings(default_fs="hdfs://nn:8020"), "s3a://b/k"),
    ],
)
def test_path_resolution(spark, path, settings, expected):
    frame = spark.createDataFrame([(path,)], "p string")
    assert frame.select(paths.resolve(F.col("p"), settings)).first()[0] == expected


def test_s3_chain(spark):
    frame = spark.createDataFrame([("s3://lake-1/raw/day=3/part.orc",)], "p string")
    rows = {r.type_name: r for r in entities.path_graph(frame, "p").collect()}
    assert rows["aws_s3_object"].qualified_name == "s3://lake-1/raw/day=3/part.orc"
    assert rows["aws_s3_pseudo_dir"].qualified_name == "s3://lake-1/raw/day=3/"
    assert rows["aws_s3_pseudo_dir"].name == "/raw/day=3/"
    assert rows["aws_s3_bucket"].qualified_name == "s3://lake-1"
    assert rows["aws_s3_object"].deps[0].qualified_name == "s3://lake-1/raw/day=3/"
    assert [rows[t].create_rank for t in ("aws_s3_bucket", "aws_s3_pseudo_dir", "aws_s3_object")] == [0, 1, 2]


def test_catalog_prefix(spark):
    rows = [
        ("in-memory", None, None, None, "app1."),
        ("hive", "thrift://meta-1.test:9099", None, None, "thrift://meta-1.test:9099."),
        ("hive", "", "org.apache.derby.jdbc.EmbeddedDriver", "jdbc:derby:x", "app1."),
        ("hive", None, "com.mysql.jdbc.Driver", "jdbc:mysql://meta-2.test/ms?autoReconnect=true",
         "jdbc:mysql://meta-2.test/ms?autoReconnect=true."),
    ]
    frame = spark.createDataFrame(rows, "impl string, uris string, driver string, url string, expected string")
    prefix = names.catalog_prefix(F.lit("app1"), F.col("impl"), F.col("uris"), F.col("driver"), F.col("url"))
    assert all(r.p == r.expected for r in frame.withColumn("p", prefix).collect())


def test_other_names(spark):
    row = spark.range(1).select(
        names.hbase_name(F.lit("primary"), F.lit("ledger"), F.lit("entry")).alias("hbase"),
        names.hbase_name(F.lit("C"), F.lit("Ns"), F.lit("Ns:T")).alias("hbase_prefixed"),
        names.hbase_name(F.lit(None).cast("string"), F.lit("n"), F.lit("t")).alias("hbase_null"),
        names.hive_name(F.lit("Mart"), F.lit("Fact7"), F.lit("Cl")).alias("hive"),
        names.kafka_name(F.lit("Topic"), F.lit("Cl")).alias("kafka"),
        names.model_uid(F.lit("pipeline_1_pipeline")).alias("model"),
        names.process_name(F.lit("Spark shell"), F.lit("a1")).alias("shell"),
        names.process_name(F.lit("job"), F.lit("a1")).alias("job"),
        names.database_identifier(F.lit(None).cast("string"), JobSettings(current_db="Cur")).alias("db"),
        names.identifier(F.lit("Tab"), JobSettings(case_sensitive=True)).alias("exact"),
        names.storage_name(F.lit("a."), F.lit("db1"), F.lit("tbl1")).alias("sd"),
    ).first()
    assert row.hbase == "ledger:entry@primary"
    assert row.hbase_prefixed == "ns:t@C"
    assert row.hbase_null is None
    assert row.hive == "mart.fact7@Cl"
    assert row.kafka == "topic@Cl"
    assert row.model == "model_1_model"
    assert row.shell == "Spark Job + a1"
    assert row.job == "job a1"
    assert row.db == "cur"
    assert row.exact == "Tab"
    assert row.sd == "a.db1.tbl1.storageFormat"


def _options(spark, *rows):
    return spark.createDataFrame(
        [("a", i, d, c, o) for i, (d, c, o) in enumerate(rows)],
        "app_id string, execution_id bigint, direction string, connector string, options map<string,string>",
    )


def test_kafka_options(spark):
    rows = _options(
        spark,
        ("input", "kafka", {"subscribe": "sparkread4,sparkread5"}),
        ("input", "kafka", {"assign": '{"sparkread6":[0,1],"sparkread7":[0,1]}'}),
        ("input", "kafka", {"subscribePattern": "sparkread[1-3]"}),
        ("output", "kafka", {"topic": "Out", "kafka.atlas.cluster.name": "customCluster"}),
        ("output", "kafka", {}),
        ("input", "kafka", {"assign": "nonsense"}),
        ("input", "kafka", {"subscribe": "t1, t2"}),
    )
    got = {(r.execution_id, r.qualified_name) for r in connectors.datasets(rows).collect()}
    assert got == {
        (0, "sparkread4@primary"),
        (0, "sparkread5@primary"),
        (1, "sparkread6@primary"),
        (1, "sparkread7@primary"),
        (3, "out@customCluster"),
        (6, "t1@primary"),
        (6, " t2@primary"),
    }
    assert [r.execution_id for r in connectors.rejected(rows).collect()] == [5]


def test_connector_classes(spark):
    known = {
        "org.apache.spark.sql.execution.datasources.jdbc.JDBCRelation": "jdbc",
        "org.apache.spark.sql.execution.datasources.hbase.DefaultSource": "hbase",
        "org.apache.spark.sql.kafka010.KafkaSourceProvider": "kafka",
        "any.vendor.hive.llap.HiveWarehouseConnector": "hwc",
        "org.example.Other": None,
    }
    frame = spark.createDataFrame([(k,) for k in known], "c string")
    got = {r.c: r.k for r in frame.select("c", connectors.connector_of(F.col("c")).alias("k")).collect()}
    assert got == known


def test_hwc_options(spark):
    rows = _options(
        spark,
        ("input", "hwc", {"table": "tbl"}),
        ("input", "hwc", {"table": "Db.tbl", "default.db": "x"}),
        ("input", "hwc", {"table": "a.b.c"}),
        ("input", "hwc", {"query": "SELECT * FROM tbl2 JOIN db.other", "default.db": "home"}),
        ("output", "hwc", {"db": "d", "table": "t"}),
        ("input", "hwc", {"query": "select 1"}),
    )
    got = {(r.execution_id, r.qualified_name) for r in connectors.datasets(rows).collect()}
    assert got == {(0, "default.tbl@primary"), (1, "db.tbl@primary"), (3, "home.tbl2@primary"), (4, "d.t@primary")}
    assert [r.execution_id for r in connectors.rejected(rows).collect()] == [2]
