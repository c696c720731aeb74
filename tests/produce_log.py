"""Run real Spark statements with the event log on. ``python produce_log.py <folder>``"""

import sys

from pyspark.sql import SparkSession

place = sys.argv[1]
spark = (
    SparkSession.builder.master("local[2]")
    .appName("producer")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.compress", "false")
    .config("spark.eventLog.dir", f"file://{place}/log")
    .config("spark.sql.maxMetadataStringLength", "100000")
    .config("spark.sql.warehouse.dir", f"{place}/wh")
    .config("spark.sql.shuffle.partitions", "2")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
print("APP", spark.sparkContext.applicationId)
spark.sql("create database db1")
spark.sql("create table db1.src(name string, age int) using parquet")
spark.sql("insert into db1.src values ('a', 1), ('b', 2)")
spark.sql("create table db1.input1 using orc as select age a from db1.src")
spark.sql("create table db1.input2 using orc as select age b from db1.src")
spark.sql("create table db1.big(a int, b int) using parquet")
spark.sql("insert into db1.big select i1.a, i2.b from db1.input1 i1 join db1.input2 i2 on i1.a = i2.b join db1.src s on s.age = i1.a")
spark.sql("insert into db1.src select * from db1.src")
spark.sql("create view db1.v as select * from db1.src")
spark.sql("create view db1.one as select 1 as x")
spark.sql("create temp view tv as select * from db1.src")
spark.sql("create table db1.fromview using parquet as select * from db1.v")
spark.sql("from (select i.a, s.name from db1.input1 i join db1.src s on i.a = s.age) x insert into db1.input2 select a insert into db1.big select a, a")
items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
items.join(orders, items.l_orderkey == orders.o_orderkey).groupBy("o_orderstatus").count().write.parquet(f"{place}/out/agg")
spark.read.parquet(f"{place}/out/agg").write.saveAsTable("db1.frompath")
spark.sql("select count(*) from db1.src").collect()
spark.sql(f"insert overwrite directory '{place}/out/dir' using parquet select * from db1.big")
try:
    spark.sql("insert into db1.big select a, cast(raise_error('boom') as int) from db1.input1").collect()
except Exception:
    pass
spark.sql("alter table db1.fromview rename to db1.renamed")
spark.sql("alter table db1.renamed set tblproperties('k'='v')")
spark.sql("drop table db1.renamed")
stream = spark.readStream.schema("name string, age int").parquet(f"{place}/wh/db1.db/src")
stream.writeStream.format("parquet").option("checkpointLocation", f"{place}/check").option("path", f"{place}/out/stream").trigger(availableNow=True).start().awaitTermination()
stream.writeStream.format("console").option("checkpointLocation", f"{place}/check2").trigger(availableNow=True).start().awaitTermination()
spark.stop()
