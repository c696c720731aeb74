"""Event tables derived from the test tables, row for row and without any cut.

Each function projects a test table to the shape a source of events has, so that the operators run
on as many rows as the table has. ``plans/standin_sql.py`` states the same projections in SQL.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.connectors import CLUSTER_OPTION, KAFKA_CLUSTER_OPTION
from weftline.sources import event_log
from weftline.sources.tables import day_number, table


def text(template: str, **values: Column) -> Column:
    """``template`` with each ``<name>`` replaced by the column of that name."""
    pieces, rest = [], template
    while "<" in rest:
        before, _, rest = rest.partition("<")
        name, _, rest = rest.partition(">")
        pieces += [F.lit(before), values[name].cast("string")]
    return F.concat(*pieces, F.lit(rest))


def chosen_text(index: Column, templates: list[str], **values: Column) -> Column:
    """The template at ``index`` with each ``<name>`` replaced by the column of that name; ``<lt>`` stands for ``<``.

    Null where a value is null. Only the one template is filled in, by one call, so the code of a row stays short."""

    def pattern(template: str) -> str:
        template = template.replace("%", "%%")
        for place, name in enumerate(values, 1):
            template = template.replace(f"<{name}>", f"%{place}$s")
        return template.replace("<lt>", "<")

    known = functools.reduce(lambda x, y: x & y, [v.isNotNull() for v in values.values()])
    return F.when(known, F.printf(pick(index, *map(pattern, templates)), *values.values()))


def options(**values: Column) -> Column:
    """Option map without the options that are null; ``__`` in a name stands for a dot."""
    keys = F.array(*[F.lit(k.replace("__", ".")) for k in values])
    return F.map_filter(F.map_from_arrays(keys, F.array(*[v.cast("string") for v in values.values()])), lambda _, v: v.isNotNull())


def pick(index: Column, *choices: Column | str) -> Column:
    """The choice at ``index``."""
    return F.element_at(F.array(*[F.lit(c) if isinstance(c, str) else c for c in choices]), index.cast("int") + 1)


ROWS_A_TASK = 20_000


def spread(frame: DataFrame, key: str) -> DataFrame:
    """``frame`` dealt to tasks of about ``ROWS_A_TASK`` rows, at least one a core.

    For short rows that grow a hundredfold in the next step. A file of one row group is one task, however large it is,
    so the number of rows decides, which Parquet's footers tell, and not that of files or splits.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(max(cores, -(-frame.count() // ROWS_A_TASK)), key)


def edges(spark: SparkSession, folder: str) -> DataFrame:
    """Process edges: one input and one output per line item."""
    order = F.col("l_orderkey")

    def side(direction: str, key: str) -> Column:
        return F.struct(
            F.lit(direction).alias("direction"),
            F.lit("spark_table").alias("type_name"),
            text("t<n>", n=F.col(key) % 40).alias("qualified_name"),
        )

    items = table(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return items.select(
        text("app-<n>", n=order % 20).alias("app_id"),
        order.alias("execution_id"),
        F.lit(0).alias("command_pos"),
        F.col("l_linenumber").cast("bigint").alias("ordinal"),
        F.inline(F.array(side("input", "l_partkey"), side("output", "l_suppkey"))),
    )


def stream_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges of micro-batches: users as queries, days as batches, event types as topics."""
    return stream_edges_of(table(spark, folder, "events", "event_id", "ts", "user_id", "event_type"))


def stream_edges_of(events: DataFrame) -> DataFrame:
    """The same projection for a table or a stream of events."""
    return events.select(
        text("q<n>", n=F.col("user_id")).alias("query_id"),
        day_number("ts").alias("batch_id"),
        F.when(F.col("event_id") % 4 == 0, "output").otherwise("input").alias("direction"),
        F.lit("kafka_topic").alias("type_name"),
        text("<t>@primary", t=F.col("event_type")).alias("qualified_name"),
    )


def paths(spark: SparkSession, folder: str) -> DataFrame:
    """Page addresses under five storage schemes."""
    rest = F.regexp_replace("url", "^https?://", "")
    scheme = pick(F.col("page_id") % 5, "s3", "s3a", "hdfs", "file", "s3n")
    return table(spark, folder, "pages", "page_id", "url").select("page_id", F.concat(scheme, F.lit("://"), rest).alias("path"))


def bare_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Page addresses without scheme and host; every third one relative."""
    rest = F.regexp_replace("url", "^https?://[^/]*", "")
    bare = F.when(F.col("page_id") % 3 == 0, F.regexp_replace(rest, "^/", "")).otherwise(rest)
    return table(spark, folder, "pages", "page_id", "url").select("page_id", bare.alias("path"))


def pushed_queries(spark: SparkSession, folder: str) -> DataFrame:
    """A query a connector pushes down for each order; its priority lies in literals and comments after words that look like clauses."""
    said = F.concat(F.lit("from x.y join "), "o_orderpriority")
    kind, n = F.col("o_orderkey") % 6, F.col("o_custkey").cast("string")
    text = pick(
        kind,
        F.concat(F.lit("select a from sales.t"), n),
        F.concat(F.lit("SELECT '"), said, F.lit("' AS c, -- "), said, F.lit("\n b FROM `t"), n, F.lit("`")),
        F.concat(F.lit("with c as (select 1 from src"), n, F.lit("), d AS (select * FROM c) select * from d join c on d.k = c.k JOIN dim")),
        F.concat(F.lit("/* "), said, F.lit("\n*/ select * from `left`.`a"), n, F.lit("` l join/**/right . b r on l.x = \""), said, F.lit("\"")),
        F.concat(F.lit("select * from (select 'it''s from q' as s from deep.t"), n, F.lit(") z")),
        F.concat(F.lit("select '"), said, F.lit("' as from_there")),
    )
    return table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderpriority").select("o_orderkey", text.alias("query"))


def _option_rows(frame: DataFrame, key: str, app: Column, direction: Column, connector: str, bag: Column) -> DataFrame:
    return frame.select(
        app.alias("app_id"),
        F.col(key).alias("execution_id"),
        direction.alias("direction"),
        F.lit(connector).alias("connector"),
        bag.alias("options"),
    )


def jdbc_options(spark: SparkSession, folder: str) -> DataFrame:
    """JDBC options: eight dialects and an unknown one, by customer."""
    db = text("Db<n>", n=F.col("c_nationkey"))
    url = pick(
        F.col("c_custkey") % 9,
        text("jdbc:mysql://h1:3306/<db>?user=u&password=p", db=db),
        text("jdbc:mariadb://h2/<db>", db=db),
        text("jdbc:db2://h3:50000/<db>", db=db),
        text("jdbc:derby:memory:<db>;create=true", db=db),
        text("jdbc:oracle:thin:u/p@h4:1521:<db>", db=db),
        text("jdbc:postgresql://h5:5432/<db>", db=db),
        text("jdbc:sqlserver://h6:1433;databaseName=<db>;integratedSecurity=true;", db=db),
        text("jdbc:teradata://h7/DATABASE=<db>/CHARSET=UTF8", db=db),
        text("jdbc:sqlite:<db>", db=db),
    )
    rows = table(spark, folder, "customer", "c_custkey", "c_name", "c_nationkey")
    bag = options(url=url, dbtable=F.col("c_name"))
    return _option_rows(rows, "c_custkey", text("app-<n>", n=F.col("c_custkey") % 20), F.lit("input"), "jdbc", bag)


def class_options(spark: SparkSession, folder: str) -> DataFrame:
    """Options whose connector is known by the class that a plan shows, one of them of no known connector."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    shown = pick(
        key % 5,
        "org.apache.spark.sql.execution.datasources.jdbc.JDBCRelation",
        "org.apache.spark.sql.execution.datasources.hbase.DefaultSource",
        "org.apache.spark.sql.kafka010.KafkaSourceProvider",
        "org.example.hive.llap.HiveWarehouseConnector",
        "org.example.Other",
    )
    bag = options(
        url=text("jdbc:mysql://h/Db<n>", n=nation), dbtable=F.col("c_name"), catalog=text('{"table":{"name":"Tab<k>"}}', k=key),
        subscribe=text("Top<n>", n=nation), table=text("Tab<n>", n=nation),
    )
    rows = table(spark, folder, "customer", "c_custkey", "c_name", "c_nationkey")
    found = _option_rows(rows, "c_custkey", text("app-<n>", n=key % 20), F.lit("input"), "", bag)
    return found.drop("connector").join(rows.select(key.alias("execution_id"), shown.alias("connector")), "execution_id")


def kafka_read_options(spark: SparkSession, folder: str) -> DataFrame:
    """Kafka reads by list, assignment, pattern and a malformed assignment."""
    shape, topic = F.col("event_id") % 4, F.col("event_type")
    bag = options(
        subscribe=F.when(shape == 0, text("<t>,Second<n>", t=topic, n=F.col("user_id") % 7)),
        assign=F.when(shape == 1, text('{"<t>":[0,1],"Third<n>":[0]}', t=topic, n=F.col("user_id") % 5)).when(
            shape == 3, text('{"<t>":"all"}', t=topic)
        ),
        subscribePattern=F.when(shape == 2, "read[1-3]"),
        **{KAFKA_CLUSTER_OPTION.replace(".", "__"): F.when(F.col("user_id") % 3 == 0, text("Cluster<n>", n=F.col("user_id") % 5))},
    )
    rows = table(spark, folder, "events", "event_id", "user_id", "event_type")
    return _option_rows(rows, "event_id", text("app-<n>", n=F.col("user_id") % 20), F.lit("input"), "kafka", bag)


def kafka_write_options(spark: SparkSession, folder: str) -> DataFrame:
    """Kafka writes; every fifth names its topic per row, streams name the cluster without prefix."""
    streaming = F.col("event_id") % 2 == 1
    cluster = F.when(F.col("user_id") % 3 == 0, text("Cluster<n>", n=F.col("user_id") % 5))
    bag = options(
        topic=F.when(F.col("event_id") % 5 != 0, F.initcap("event_type")),
        **{
            KAFKA_CLUSTER_OPTION.replace(".", "__"): F.when(~streaming, cluster),
            CLUSTER_OPTION.replace(".", "__"): F.when(streaming, cluster),
        },
    )
    rows = table(spark, folder, "events", "event_id", "user_id", "event_type")
    return _option_rows(rows, "event_id", text("app-<n>", n=F.col("user_id") % 20), F.lit("output"), "kafka", bag)


def progress(spark: SparkSession, folder: str) -> DataFrame:
    """Progress of micro-batches: per event one batch of a Kafka source and a file sink."""
    number, topic = F.col("event_id"), F.col("event_type")
    end = text('{"<t>":{"0":<e>,"1":7},"quiet":{"0":3}}', t=topic, e=10 + number % 3)
    begin = F.when(number % 5 != 0, text('{"<t>":{"0":10,"1":7},"quiet":{"0":3}}', t=topic))
    source = F.struct(
        F.lit("KafkaV2[Subscribe[any]]").alias("description"), begin.alias("startOffset"), end.alias("endOffset")
    )
    files = F.struct(
        F.lit("FileStreamSource[file:/in]").alias("description"),
        F.lit(None).cast("string").alias("startOffset"),
        F.lit('{"logOffset":0}').alias("endOffset"),
    )
    sink = pick(
        number % 3,
        text("FileSink[hdfs://nn:8020/Out/<u>]", u=F.col("user_id")),
        "org.apache.spark.sql.execution.streaming.ConsoleTable$@1",
        "ForeachBatchSink",
    )
    return table(spark, folder, "events", "event_id", "user_id", "event_type").select(
        text("app-<n>", n=F.col("user_id") % 20).alias("app_id"),
        text("q<n>", n=F.col("user_id")).alias("query_id"),
        number.alias("batch_id"),
        F.array(source, files).alias("sources"),
        sink.alias("sink_description"),
    )


def hbase_options(spark: SparkSession, folder: str) -> DataFrame:
    """HBase catalogs: with and without namespace, with a prefixed table name, empty, with a cluster."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    catalog = pick(
        key % 4,
        text('{"table":{"namespace":"Ns<n>","name":"Tab<k>"},"rowkey":"id"}', n=nation, k=key),
        text('{"table":{"name":"Tab<k>"}}', k=key),
        text('{"table":{"namespace":"Ns<n>","name":"Ns<n>:Tab<k>"}}', n=nation, k=key),
        "",
    )
    bag = options(catalog=catalog, **{CLUSTER_OPTION.replace(".", "__"): F.when(key % 3 == 0, text("C<n>", n=nation))})
    rows = table(spark, folder, "customer", "c_custkey", "c_nationkey")
    return _option_rows(rows, "c_custkey", text("app-<n>", n=key % 20), F.lit("input"), "hbase", bag)


def hwc_options(spark: SparkSession, folder: str) -> DataFrame:
    """Hive-connector options: plain, qualified, over-qualified, by query, by writer fields."""
    key, size = F.col("p_partkey"), F.col("p_size")
    shape = key % 6
    named = F.when(shape == 0, text("Tab<n>", n=size)).when(shape == 1, text("Db<k>.Tab<n>", k=key % 9, n=size))
    named = named.when(shape == 2, text("a.Db<k>.Tab<n>", k=key % 9, n=size)).when(shape == 4, text("Tab<n>", n=size))
    query = F.when(
        shape == 3, text("select a.x from `Db<k>`.Tab<n> a join other b on a.x = b.x", k=key % 9, n=size)
    ).when(shape == 5, pick(key % 4 / 2, text("select x from Tab<n> where x > 1", n=size), "select 1"))
    bag = options(
        table=named,
        query=query,
        db=F.when(shape == 4, text("Field<k>", k=key % 9)),
        default__db=F.when(key % 5 == 0, "Home"),
    )
    direction = F.when(shape == 4, "output").otherwise("input")
    rows = table(spark, folder, "part", "p_partkey", "p_size")
    return _option_rows(rows, "p_partkey", text("app-<n>", n=key % 20), direction, "hwc", bag)


def catalogs(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog settings of one application per customer, in the five ways a catalog can be set up."""
    key = F.col("c_custkey")
    shape = key % 5
    return table(spark, folder, "customer", "c_custkey", "c_nationkey").select(
        key.alias("key"),
        text("app-<n>", n=key).alias("app_id"),
        F.when(shape == 0, F.lit(None)).when(shape == 1, "in-memory").otherwise("hive").alias("implementation"),
        F.when(shape == 2, text(" thrift://ms<n>:9083 ", n=F.col("c_nationkey"))).when(shape == 3, " ").alias("metastore_uris"),
        F.when(shape == 3, "org.apache.derby.jdbc.EmbeddedDriver").when(shape == 4, "com.mysql.jdbc.Driver").alias("connection_driver"),
        F.when(shape == 4, text("jdbc:mysql://h/hive<n>", n=F.col("c_nationkey"))).alias("connection_url"),
        F.when(key % 7 != 0, text("Db<n>", n=F.col("c_nationkey"))).alias("db"),
        text("Tab<n>", n=key).alias("table"),
    )


def applications(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty applications the other stand-ins name; the last two use a remote metastore."""
    number = (F.col("o_custkey") % 20).alias("n")
    keys = table(spark, folder, "orders", "o_custkey").select(number).distinct()
    remote = F.col("n") >= 18
    return keys.select(
        text("app-<n>", n=F.col("n")).alias("app_id"),
        F.when(F.col("n") == 0, "Spark shell").otherwise(text("job<n>", n=F.col("n"))).alias("app_name"),
        text("user<n>", n=F.col("n") % 3).alias("user"),
        F.when(remote, "thrift://ms:9083.").otherwise(text("app-<n>.", n=F.col("n"))).alias("prefix"),
        remote.alias("remote_hms"),
    )


def _catalog_scope(key: Column) -> list[Column]:
    return [text("app-<n>", n=key % 20).alias("app_id"), text("db<n>", n=key % 25).alias("db")]


def catalog_dbs(spark: SparkSession, folder: str) -> DataFrame:
    """Database definitions; a third of the databases are defined only from sequence number 3000 on."""
    key = (F.col("c_custkey") % 100).alias("k")
    keys = table(spark, folder, "customer", "c_custkey").select(key).distinct()
    k = F.col("k")
    return keys.select(
        *_catalog_scope(k),
        F.when(k % 3 == 0, 3000).otherwise(0).cast("bigint").alias("since"),
        F.when(k % 4 != 0, text("database <n>", n=k)).alias("description"),
        text("<root>/Wh/db<n>", root=pick(k % 3, "hdfs://nn:8020", "s3a://lake", "file:"), n=k % 25).alias("location"),
        F.create_map(F.lit("k"), k.cast("string")).alias("parameters"),
        text("owner<n>", n=k % 6).alias("owner"),
    )


def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Table definitions by customer; every third is altered at sequence number 5000."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    altered = F.col("since") > 0
    versions = F.when(key % 3 == 0, F.array(F.lit(0), F.lit(5000))).otherwise(F.array(F.lit(0)))
    rows = table(spark, folder, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    return rows.withColumn("since", F.explode(versions.cast("array<bigint>"))).select(
        *_catalog_scope(key),
        text("t<n>", n=key).alias("name"),
        "since",
        pick(key % 3, "MANAGED", "EXTERNAL", "VIEW").alias("table_type"),
        F.when(key % 4 != 0, pick(key % 2, "parquet", "orc")).alias("provider"),
        text("struct<lt>id:bigint,c<n>:string<gt>", lt=F.lit("<"), n=nation, gt=F.lit(">")).alias("schema_desc"),
        text("owner<n>", n=key % 6).alias("owner"),
        (key * 86400000).cast("bigint").alias("create_time"),
        F.when(altered, "altered").when(key % 2 == 0, F.lower("c_mktsegment")).alias("comment"),
        F.when(key % 2 == 0, F.array(F.lit("p"))).otherwise(F.array().cast("array<string>")).alias("partition_columns"),
        F.when(key % 5 == 0, F.create_map(F.lit("numBuckets"), (nation + 1).cast("string"))).alias("bucket_spec"),
        F.create_map(F.lit("n"), nation.cast("string")).alias("parameters"),
        F.when(key % 3 != 2, text("hdfs://nn:8020/Wh/t<n>", n=key)).alias("location"),
        F.when(key % 4 == 1, "in.Format").alias("input_format"),
        F.when(key % 4 == 1, "out.Format").alias("output_format"),
        F.when(key % 4 == 2, "a.Serde").alias("serde"),
        (key % 7 == 0).alias("compressed"),
        F.create_map(F.lit("path"), text("/p<n>", n=key)).alias("storage_parameters"),
        (key % 2 == 0).alias("tracks_partitions"),
        F.array().cast("array<string>").alias("unsupported_features"),
    )


def catalog_events(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog events: the order number is the sequence and selects the event."""
    seq, key = F.col("o_orderkey"), F.col("o_custkey")
    shape = seq % 10
    event = pick(
        shape,
        "CreateDatabase",
        "AlterDatabase",
        "CreateTable",
        "RenameTable",
        "AlterTable",
        "AlterTable",
        "DropTable",
        "DropDatabasePre",
        "DropDatabase",
        "CreateTablePre",
    )
    about_table = shape.isin(2, 3, 4, 5, 6, 9)
    return table(spark, folder, "orders", "o_orderkey", "o_custkey").select(
        *_catalog_scope(key),
        seq.alias("seq"),
        event.alias("event"),
        F.when(about_table, text("t<n>", n=key)).alias("name"),
        F.when(shape == 3, text("r<n>", n=key)).alias("new_name"),
        F.when(shape == 4, "table").when(shape == 5, pick(key % 3, "dataSchema", "schema", "stats")).alias("kind"),
    )


def ml_events(spark: SparkSession, folder: str) -> DataFrame:
    """Machine-learning events: the document number is the sequence, languages name pipelines."""
    seq = F.col("doc_id")
    event = pick(
        F.floor(seq / 20) % 7,
        "CreatePipeline",
        "CreateModel",
        "SavePipeline",
        "SaveModel",
        "LoadModel",
        "Transform",
        "Other",
    )
    root = pick(seq % 3, "hdfs://nn:8020/Ml", "s3a://models/ml", "file:/Ml")
    return table(spark, folder, "documents", "doc_id", "lang").select(
        text("app-<n>", n=seq % 20).alias("app_id"),
        seq.alias("seq"),
        event.alias("event"),
        text("pipeline_<l>", l=F.col("lang")).alias("uid"),
        text("<r>/<l>/<n>", r=root, l=F.col("lang"), n=seq).alias("directory"),
        seq.alias("dataset_execution_id"),
    )


def training_edges(spark: SparkSession, folder: str) -> DataFrame:
    """What the training data of a document's pipeline was read from, by its labels."""
    return table(spark, folder, "labels", "doc_id", "quality", "toxic").select(
        text("app-<n>", n=F.col("doc_id") % 20).alias("app_id"),
        F.col("doc_id").alias("execution_id"),
        F.lit("input").alias("direction"),
        F.lit("spark_table").alias("type_name"),
        text("train.q<q>t<t>", q=F.col("quality"), t=F.col("toxic")).alias("qualified_name"),
    )


# --- event logs -----------------------------------------------------------------------------------

NESTED = 1_000_000_000

_JOIN = """<pad>+- * SortMergeJoin Inner (3)
<pad>   :- <a> (1)
<pad>   +- <b> (2)"""

_JOIN_DETAIL = """

(1) <a>
<ad>

(2) <b>
<bd>

(3) SortMergeJoin
Join condition: None
"""


def _kind() -> Column:
    return F.col("k") % 16


def _leaves(logical: bool, shape: int) -> dict[str, str]:
    """The two leaves of a statement, as a logical or a physical plan prints them; the second has four shapes."""
    if logical:
        a, ad = "LogicalRelation", "Arguments: parquet, [x#1], `spark_catalog`.`db<d>`.`src<s>`, false"
        b = ["LogicalRelation", "HiveTableRelation", "LocalRelation", "LogicalRelation"]
        bd = [
            "Arguments: parquet, [x#2], false",
            "Arguments: [`db<d>`.`h<h>`, org.apache.hadoop.hive.ql.io.orc.OrcSerde, [x#2]]",
            "Arguments: [x#2]",
            "Arguments: JDBCRelation(tab) [numPartitions=1], [x#2], false",
        ]
    else:
        a = "Scan parquet spark_catalog.db<d>.src<s>"
        ad = "Batched: true\nLocation: InMemoryFileIndex [file:/wh/db<d>.db/src<s>]\nReadSchema: struct<lt>x:int>"
        b = ["Scan parquet ", "Scan hive db<d>.h<h>", "LocalTableScan", "Scan JDBCRelation(tab) [numPartitions=1]"]
        bd = [
            "Location: InMemoryFileIndex [hdfs://nn:8020/Raw/<r>, ... 1 entries]\nReadSchema: struct<lt>x:int>",
            "Arguments: [x#2], HiveTableRelation",
            "Arguments: [x#2]",
            "PushedFilters: []",
        ]
    return {"a": a, "ad": ad, "b": b[shape], "bd": bd[shape]}


def _plan(head: str, tail: str, pad: int, logical: bool = False) -> list[str]:
    """Printed plans by shape: ``head`` lines over the join of the two leaves, then the paragraphs, then ``tail``."""
    body = "== Physical Plan ==\n" + head + "\n" + _JOIN + "\n\n" + _JOIN_DETAIL + tail + "\n\n"
    body = body.replace("<pad>", " " * pad)

    def shaped(shape: int) -> str:
        leaves = _leaves(logical, shape)
        return functools.reduce(lambda done, name: done.replace(f"<{name}>", leaves[name]), leaves, body)

    return [shaped(shape) for shape in range(4)]


def _executed(command: str, arguments: str, logical: bool = True) -> list[str]:
    """Plans of a command that Spark runs eagerly: printed as ``Execute X`` over ``X``."""
    head = f"Execute {command} (4)\n   +- {command} (5)"
    tail = f"\n(4) Execute {command}\nOutput: []\n\n(5) {command}\nArguments: {arguments}"
    return _plan(head, tail, 9, logical)


def _written(command: str, arguments: str) -> list[str]:
    """Plans of a writing command, under an adaptive plan."""
    head = f"AdaptiveSparkPlan (6)\n+- Execute {command} (5)\n   +- WriteFiles (4)"
    tail = f"\n(4) WriteFiles\nInput [1]: [x#1]\n\n(5) Execute {command}\nInput: []\nArguments: {arguments}\n\n(6) AdaptiveSparkPlan\nArguments: isFinalPlan=false"
    return _plan(head, tail, 6)


def _alone(command: str, arguments: str) -> list[str]:
    """Plan of a command without a query, the same for every shape."""
    body = (
        f"== Physical Plan ==\nExecute {command} (1)\n   +- {command} (2)\n\n\n(1) Execute {command}\nOutput: []\n\n"
        f"(2) {command}\nArguments: {arguments}\n\n"
    )
    return [body] * 4


_MULTI_INSERT = """== Physical Plan ==
Union (7)
:- Execute InsertIntoHadoopFsRelationCommand (3)
:  +- WriteFiles (2)
:     +- * ColumnarToRow (1)
:        +- Scan parquet spark_catalog.db<d>.left<s> (8)
+- Execute InsertIntoHadoopFsRelationCommand (6)
   +- WriteFiles (5)
      +- Scan parquet spark_catalog.db<d>.right<s> (4)


(1) ColumnarToRow
Input [1]: [x#1]

(2) WriteFiles
Input [1]: [x#1]

(3) Execute InsertIntoHadoopFsRelationCommand
Input: []
Arguments: file:/wh/m1, false, ORC, [path=file:/wh/m1], Append, `spark_catalog`.`db<d>`.`multi<s>`, org.apache.spark.sql.execution.datasources.InMemoryFileIndex(file:/wh/m1), [x]

(4) Scan parquet spark_catalog.db<d>.right<s>
Location: InMemoryFileIndex [file:/wh/right<s>]

(5) WriteFiles
Input [1]: [x#2]

(6) Execute InsertIntoHadoopFsRelationCommand
Input: []
Arguments: file:/wh/<k>, false, ORC, [path=file:/wh/<k>], Append, [x]

(7) Union

(8) Scan parquet spark_catalog.db<d>.left<s>
Location: InMemoryFileIndex [file:/wh/left<s>]

"""


def statement_plans(spark: SparkSession, folder: str) -> DataFrame:
    """One statement per order, of sixteen kinds: ``k, c, failed, finished, plan, nested_plan``."""
    k, c = F.col("k"), F.col("c")
    shape = c % 4
    v = dict(d=c % 5, s=c % 40, h=c % 30, r=c % 100, c=c % 50, k=k)
    # Every eighth statement of the first kind writes the table it reads.
    target = F.when(c % 8 == 0, text("src<o>", o=c % 40)).otherwise(text("out<o>", o=c % 40))
    location = F.when(c % 10 == 0, "Storage()").otherwise(text("Storage(Location: hdfs://nn:8020/Dir/<k>)", k=k))
    savers = ["jdbc.JdbcRelationProvider@1", "hbase.DefaultSource@1", "kafka010.KafkaSourceProvider@1", "other.Provider@1"]
    saves = _executed("SaveIntoDataSourceCommand", "org.example.<p>, [url=*********(redacted)], Append")
    project = _plan("* Project (4)", "\n(4) Project\nOutput [1]: [x#1]", 0)
    kinds = [
        _written("InsertIntoHadoopFsRelationCommand", "file:/wh/x, false, ORC, [path=file:/wh/x], Append, `spark_catalog`.`db<d>`.`<t>`, org.apache.spark.sql.execution.datasources.InMemoryFileIndex(file:/wh/x), [x]"),
        _written("InsertIntoHadoopFsRelationCommand", "s3a://lake/d<c>/f<k>, false, Parquet, [path=s3a://lake/d<c>/f<k>], Overwrite, [x]"),
        _executed("CreateDataSourceTableAsSelectCommand", "`spark_catalog`.`db<d>`.`ctas<k>`, ErrorIfExists, [x]"),
        _executed("CreateViewCommand", "`spark_catalog`.`db<d>`.`view<k>`, select * from x, false, false, PersistedView, COMPENSATION, true"),
        _executed("CreateViewCommand", "`view<k>`, select * from x, false, false, LocalTempView, UNSUPPORTED, true"),
        _alone("CreateDataSourceTableCommand", "`spark_catalog`.`db<d>`.`new<k>`, false"),
        _alone("LoadDataCommand", "`spark_catalog`.`db<d>`.`load<s>`, hdfs://nn:8020/Load/<k>, false, false"),
        _written("InsertIntoHiveDirCommand", "false, <l>, [x]"),
        project,
        [save.replace("<p>", saver) for save, saver in zip(saves, savers, strict=True)],
        [_MULTI_INSERT] * 4,
        _plan("AppendData (4)", "\n(4) AppendData\nArguments: org.example.Writer@1", 0),
        _written("InsertIntoHiveTable", "`spark_catalog`.`db<d>`.`hive<s>`, org.apache.hadoop.hive.ql.io.orc.OrcSerde, false, false, [x]"),
        _executed("CreateHiveTableAsSelectCommand", "`db<d>`.`hctas<k>`, [x], ErrorIfExists"),
        project,
        _alone("CreateTableCommand", "`spark_catalog`.`db<d>`.`hnew<k>`, false"),
    ]
    plan = chosen_text(_kind() * 4 + shape, sum(kinds, []), t=target, l=location, **v)
    inner = _written("InsertIntoHadoopFsRelationCommand", "file:/wh/c<k>, false, ORC, [path=file:/wh/c<k>], Overwrite, [x]")
    nested = F.when(_kind().isin(2, 9, 13), chosen_text(F.when(_kind() == 9, 4).otherwise(0) + shape, inner + project, **v))
    rows = spread(table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), "o_orderkey")
    running = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    return rows.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("c"),
        (F.col("o_orderpriority") == "5-LOW").alias("failed"),
        (~running).alias("finished"),
    ).select("*", plan.alias("plan"), nested.alias("nested_plan"))


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Event-log lines: starts and ends of all statements and their nested executions, progress of the
    streaming ones, and the application events."""
    k = F.col("k")
    app = text("app-<n>", n=F.col("c") % 20)
    streaming = _kind() == 14
    query = text("q<n>", n=F.col("c") % 90)
    described = F.when(streaming, text("\nid = <q>\nrunId = r\nbatch = <k>", q=query, k=k)).otherwise("sql at app.py:1")

    # The printed plan shows the first of several paths, the plan graph all.
    c = F.col("c")
    whole = text("InMemoryFileIndex(2 paths)[hdfs://nn:8020/Raw/<r>, s3a://lake/in/<i>]", r=c % 100, i=c % 7)
    graph = F.struct(F.lit("Scan parquet ").alias("nodeName"), F.struct(whole.alias("Location"), F.lit("[]").alias("PushedFilters")).alias("metadata"))

    def start(number: Column, plan: Column) -> Column:
        return F.to_json(
            F.struct(
                F.lit(event_log.SQL_START).alias("Event"),
                number.alias("executionId"),
                k.alias("rootExecutionId"),
                described.alias("description"),
                plan.alias("physicalPlanDescription"),
                F.struct(F.lit("AdaptiveSparkPlan").alias("nodeName"), F.array(graph).alias("children")).alias("sparkPlanInfo"),
                (k * 1000).alias("time"),
            )
        )

    def end(number: Column, failed: Column) -> Column:
        return F.to_json(
            F.struct(
                F.lit(event_log.SQL_END).alias("Event"),
                number.alias("executionId"),
                (k * 1000 + 500).alias("time"),
                F.when(failed, "boom").otherwise("").alias("errorMessage"),
            )
        )

    progress_record = F.to_json(
        F.struct(
            F.lit(event_log.QUERY_PROGRESS).alias("Event"),
            F.struct(
                query.alias("id"),
                k.alias("batchId"),
                F.array().cast("array<struct<description:string,startOffset:string,endOffset:string>>").alias("sources"),
                F.struct(text("FileSink[hdfs://nn:8020/Stream/<n>]", n=F.col("c") % 90).alias("description")).alias("sink"),
            ).alias("progress"),
        )
    )
    nested = F.col("nested_plan").isNotNull()

    def line(offset: int, value: Column) -> Column:
        return F.struct((k * 8 + offset).alias("place"), value.alias("value"))

    events = F.array(
        line(0, start(k, F.col("plan"))),
        F.when(nested, line(1, start(k + NESTED, F.col("nested_plan")))),
        F.when(nested, line(2, end(k + NESTED, F.lit(False)))),
        F.when(F.col("finished"), line(3, end(k, F.col("failed")))),
        F.when(streaming & F.col("finished"), line(4, progress_record)),
    )
    # The outer form, because for the inner one Spark infers a filter on the array and would write every line again in it.
    # Lines that a statement lacks are null here; ``lines_of`` drops them with those of no known kind.
    statements = statement_plans(spark, folder).select(_log_file(app).alias("file"), F.inline_outer(events))

    def properties(**values: Column) -> Column:
        pairs = [x for key, value in values.items() for x in (F.lit(key.replace("__", ".")), value)]
        return F.create_map(*pairs)

    apps = applications(spark, folder)
    uris = F.when(F.col("remote_hms"), "thrift://ms:9083").otherwise("")
    start_event = F.to_json(
        F.struct(
            F.lit(event_log.APP_START).alias("Event"),
            F.col("app_name").alias("App Name"),
            F.col("app_id").alias("App ID"),
            F.col("user").alias("User"),
        )
    )
    environment = F.to_json(
        F.struct(
            F.lit(event_log.ENVIRONMENT).alias("Event"),
            properties(
                spark__app__name=F.col("app_name"),
                spark__sql__catalogImplementation=F.when(F.col("remote_hms"), "hive").otherwise("in-memory"),
            ).alias("Spark Properties"),
            properties(fs__defaultFS=F.lit("hdfs://nn:8020"), hive__metastore__uris=uris).alias("Hadoop Properties"),
        )
    )
    # As one generator, whose rows a filter does not pass on its way to the orders the applications are told from.
    file = _log_file(F.col("app_id")).alias("file")
    both = [F.struct(file, F.lit(place).cast("bigint").alias("place"), value.alias("value")) for place, value in ((0, start_event), (1, environment))]
    return event_log.lines_of(statements.unionByName(apps.select(F.inline_outer(F.array(*both)))))


def _log_file(app: Column) -> Column:
    """Names of log files: rolled, plain, and still growing ones."""
    shape = F.regexp_extract(app, r"(\d+)$", 1).cast("int") % 3
    rolled = F.concat(F.lit("hdfs://nn/logs/eventlog_v2_"), app, F.lit("/events_1_"), app, F.lit(".zstd"))
    return F.concat(pick(shape, rolled, F.concat(F.lit("hdfs://nn/logs/"), app), F.concat(F.lit("hdfs://nn/logs/"), app, F.lit(".inprogress"))))


def statement_options(spark: SparkSession, folder: str) -> DataFrame:
    """Connector options of the statements: what JDBC leaves read and what saves and V2 writes wrote."""
    k, c = F.col("k"), F.col("c")
    rows = spread(table(spark, folder, "orders", "o_orderkey", "o_custkey"), "o_orderkey").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c")
    )
    jdbc = options(url=F.lit("jdbc:mysql://h/Src"), dbtable=text("Tab<n>", n=c % 20))
    read = F.struct(F.lit("input").alias("direction"), F.lit("jdbc").alias("connector"), jdbc.alias("options"))

    def write(connector: str, bag: Column) -> Column:
        return F.struct(F.lit("output").alias("direction"), F.lit(connector).alias("connector"), bag.alias("options"))

    saved = pick(
        c % 4,
        write("jdbc", options(url=F.lit("jdbc:postgresql://h/Dst"), dbtable=text("Out<n>", n=c % 20))),
        write("hbase", options(catalog=text('{"table":{"name":"Out<n>"}}', n=c % 20))),
        write("kafka", options(topic=text("Out<n>", n=c % 20))),
        write("other", options(x=F.lit("y"))),
    )
    v2 = pick(c % 2, write("kafka", options(topic=text("V2<n>", n=c % 20))), write("hwc", options(table=text("W.V2<n>", n=c % 20))))
    listed = F.filter(
        F.array(F.when(c % 4 == 3, read), F.when(_kind() == 9, saved).when(_kind() == 11, v2)), lambda o: o.isNotNull()
    )
    found = rows.select(text("app-<n>", n=c % 20).alias("app_id"), k.alias("execution_id"), F.inline_outer(listed))
    return found.where("connector is not null")


def statement_catalog(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Definitions, databases and catalog events of the tables that statements name, in milliseconds of the log.

    Some tables are altered, dropped, renamed twice, or never defined; one application's database is dropped and one kind of
    application defines its database late."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey")
    s = F.col("s")
    lists = orders.select((F.col("o_custkey") % 40).alias("s")).distinct()

    def version(name: str, since: Column | int, comment: str, when: Column | None = None) -> Column:
        made = F.struct(text(f"{name}<s>", s=s).alias("name"), F.lit(since).cast("bigint").alias("since"), F.lit(comment).alias("comment"))
        return made if when is None else F.when(when, made)

    listed = F.array(
        version("src", 0, "first"),
        version("out", 0, "first"),
        version("out", 2_000_000, "altered", s % 3 == 0),
        version("old", 0, "renamed", s % 2 == 0),
        version("left", 0, "first", s % 2 == 1),
        version("right", 0, "first"),
        version("load", 1_500_000, "late"),
        version("multi", 0, "first", s % 5 != 0),
    )
    shared = lists.select(s, F.inline(F.filter(listed, lambda x: x.isNotNull())))
    k, kind = F.col("o_orderkey"), F.col("o_orderkey") % 16
    made = F.when(kind == 2, "ctas").when(kind == 13, "hctas").when(kind == 5, "new").when(kind == 15, "hnew").when((kind == 3) & (F.col("o_custkey") % 2 == 0), "view")
    own = orders.where(made.isNotNull()).select((F.col("o_custkey") % 40).alias("s"), F.concat(made, k.cast("string")).alias("name"), (k * 1000 + 200).alias("since"), F.lit("made").alias("comment"))
    none, no_map = F.lit(None).cast("string"), F.lit(None).cast("map<string,string>")
    scope = [text("app-<n>", n=s % 20).alias("app_id"), text("db<n>", n=s % 5).alias("db")]
    tables = shared.unionByName(own).select(
        *scope, "name", "since", F.lit("MANAGED").alias("table_type"), F.lit("parquet").alias("provider"), F.lit("struct<x:bigint>").alias("schema_desc"), text("owner<n>", n=s % 6).alias("owner"),
        F.lit(0).cast("bigint").alias("create_time"), "comment", F.array().cast("array<string>").alias("partition_columns"), no_map.alias("bucket_spec"), no_map.alias("parameters"),
        F.concat(F.lit("hdfs://nn:8020/Wh/"), F.col("name")).alias("location"), none.alias("input_format"), none.alias("output_format"), none.alias("serde"), F.lit(False).alias("compressed"),
        no_map.alias("storage_parameters"), F.lit(False).alias("tracks_partitions"), F.array().cast("array<string>").alias("unsupported_features"),
    )
    apps = lists.select((s % 20).alias("s")).distinct()
    dbs = apps.select(
        *scope, F.when(s % 7 == 3, 2_000_000).otherwise(0).cast("bigint").alias("since"), text("database <n>", n=s % 5).alias("description"), text("hdfs://nn:8020/Wh/db<n>", n=s % 5).alias("location"),
        no_map.alias("parameters"), F.lit("dba").alias("owner"),
    )

    def event(kind: str, seq: int, name: Column, new_name: Column = none) -> list[Column]:
        return [*scope, F.lit(seq).cast("bigint").alias("seq"), F.lit(kind).alias("event"), name.alias("name"), new_name.alias("new_name"), none.alias("kind")]

    old, mid, left = (text(f"{x}<s>", s=s) for x in ("old", "mid", "left"))
    # Numbers of one application differ, as places in its log do.
    events = lists.where(s % 2 == 0).select(*event("RenameTable", 1_000_000, old, mid)).withColumn("seq", F.col("seq") + F.regexp_extract("name", r"(\d+)$", 1).cast("bigint"))
    again = lists.where(s % 2 == 0).select(*event("RenameTable", 2_500_000, mid, left)).withColumn("seq", F.col("seq") + F.regexp_extract("name", r"(\d+)$", 1).cast("bigint"))
    dropped = lists.where(s % 4 == 1).select(*event("DropTable", 3_000_000, text("right<s>", s=s))).withColumn("seq", F.col("seq") + F.regexp_extract("name", r"(\d+)$", 1).cast("bigint"))
    lost = apps.where(s == 4).select(*event("DropDatabase", 4_000_001, none))
    return tables, dbs, events.unionByName(again).unionByName(dropped).unionByName(lost)


def retried_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of applications that were started twice: every statement that writes a path, dealt to two runs which both count from 0.

    Of each pair of statements with one number the first run's fails, for some applications."""
    k, c = F.col("k"), F.col("c")
    rows = statement_plans(spark, folder).where((k % 16 == 1) & F.col("finished"))
    run, number = (F.floor(k / 16) % 2 + 1).cast("int"), F.floor(k / 32)
    app = text("application_17_<n>", n=c % 20)
    file = F.concat(F.lit("hdfs://nn/logs/"), app, F.lit("_"), run.cast("string"))
    start = F.to_json(F.struct(F.lit(event_log.SQL_START).alias("Event"), number.alias("executionId"), F.lit("sql").alias("description"), F.col("plan").alias("physicalPlanDescription"), (k * 1000).alias("time")))
    failed = F.col("failed") | ((run == 1) & (c % 3 == 0))
    end = F.to_json(F.struct(F.lit(event_log.SQL_END).alias("Event"), number.alias("executionId"), (k * 1000 + 500).alias("time"), F.when(failed, "boom").otherwise("").alias("errorMessage")))
    both = F.array(F.struct((k * 8).alias("place"), start.alias("value")), F.struct((k * 8 + 1).alias("place"), end.alias("value")))
    lines = rows.select(file.alias("file"), F.inline(both))
    n = F.regexp_extract("app_id", r"(\d+)$", 1)
    runs = applications(spark, folder).select(F.concat(F.lit("application_17_"), n).alias("app_id"), "app_name", "user", F.explode(F.array(F.lit(1), F.lit(2))).alias("run"))
    began = F.to_json(F.struct(F.lit(event_log.APP_START).alias("Event"), F.col("app_name").alias("App Name"), F.col("app_id").alias("App ID"), F.col("run").cast("string").alias("App Attempt ID"), F.col("user").alias("User")))
    opened = runs.select(F.concat(F.lit("hdfs://nn/logs/"), "app_id", F.lit("_"), F.col("run").cast("string")).alias("file"), F.lit(0).cast("bigint").alias("place"), began.alias("value"))
    return event_log.lines_of(lines.unionByName(opened))


_TWO_SCANS = """== Physical Plan ==
Execute InsertIntoHadoopFsRelationCommand (4)
+- Union (3)
   :- Scan parquet (1)
   +- Scan parquet (2)


(1) Scan parquet
Location: InMemoryFileIndex [file:/a<s>, ... 1 entries]

(2) Scan parquet
Location: InMemoryFileIndex [file:/a<s>, ... 1 entries]

(3) Union

(4) Execute InsertIntoHadoopFsRelationCommand
Arguments: file:/o<k>, false, Parquet, [path=file:/o<k>], Overwrite, [x]

"""


def two_scan_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A statement per order that reads two lists of paths which begin alike; the graph of every fifth shows one of them, of every seventh none whole."""
    k = F.col("o_orderkey")
    rows = spread(table(spark, folder, "orders", "o_orderkey", "o_custkey"), "o_orderkey")
    v = dict(s=k % 3, b=k % 7, c=k % 11)
    lists = [text("InMemoryFileIndex(2 paths)[file:/a<s>, file:/b<b>]", **v), text("InMemoryFileIndex(2 paths)[file:/a<s>, file:/c<c>]", **v)]
    cut = text("InMemoryFileIndex(2 paths)[file:/a<s>, ...]", **v)

    def scan(location: Column) -> Column:
        return F.struct(F.lit("Scan parquet ").alias("nodeName"), F.struct(location.alias("Location")).alias("metadata"))

    whole = F.when(k % 5 == 0, F.array(scan(lists[0]))).when(k % 7 == 0, F.array(scan(cut), scan(lists[1]))).otherwise(F.array(*map(scan, lists)))
    graph = F.struct(F.lit("Union").alias("nodeName"), whole.alias("children"))
    plan = text(_TWO_SCANS, s=k % 3, k=k)
    start = F.to_json(F.struct(F.lit(event_log.SQL_START).alias("Event"), k.alias("executionId"), plan.alias("physicalPlanDescription"), graph.alias("sparkPlanInfo"), (k * 1000).alias("time")))
    return event_log.lines_of(rows.select(text("hdfs://nn/logs/app-<n>", n=F.col("o_custkey") % 20).alias("file"), k.alias("place"), start.alias("value")))


def entity_dependencies(spark: SparkSession, folder: str) -> DataFrame:
    """What entities of statements need: an application its objects and tables, an object its folder, that its bucket; and five
    views which need each other in a ring, with a sixth that needs one of them."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, folder, "orders", "o_orderkey", "o_custkey")
    app = text("app-<n>", n=c % 20)
    folder_name = text("s3://lake/d<n>/", n=c % 50)
    thing = text("s3://lake/d<n>/f<k>", n=c % 50, k=k)
    own = text("app-<a>.db<d>.t<t>", a=c % 20, d=c % 5, t=c % 40)

    def needs(type_name: str, name: Column, dep_type: str, dep: Column) -> Column:
        return F.struct(F.lit(type_name).alias("type_name"), name.alias("qualified_name"), F.lit(dep_type).alias("dep_type_name"), dep.alias("dep_qualified_name"))

    listed = F.array(
        needs("spark_process", app, "aws_s3_object", thing),
        needs("aws_s3_object", thing, "aws_s3_pseudo_dir", folder_name),
        needs("aws_s3_pseudo_dir", folder_name, "aws_s3_bucket", F.lit("s3://lake")),
        needs("spark_process", app, "spark_table", own),
        needs("spark_table", own, "spark_db", text("app-<a>.db<d>", a=c % 20, d=c % 5)),
        needs("spark_table", own, "spark_storagedesc", F.concat(own, F.lit(".storageFormat"))),
    )
    n = F.col("n_nationkey")
    ring = table(spark, folder, "nation", "n_nationkey").where(n < 6)
    ring = ring.select(needs("view", text("v<n>", n=n), "view", text("v<m>", m=F.when(n == 5, 0).otherwise((n + 1) % 5))).alias("x")).select("x.*")
    return rows.select(F.inline(listed)).unionByName(ring)
