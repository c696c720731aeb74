"""From executed plans to process edges: which datasets each statement read and wrote.

``facts`` reads each plan once, inside its row, and keeps only what lineage needs: the commands and
the leaves with what they read. Written to a table, facts are a small fraction of the plan text, and
everything after works from them. Two shuffles follow, both on the statement key
``(app_id, root_execution_id)``: choosing the execution that speaks for the statement (an aggregate,
combined before it shuffles), and meeting the statement's leaves (an equi-join, which Spark splits
when one statement is very large).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import names, paths
from weftline.functions import plan_text as pt
from weftline.functions.values import once
from weftline.operators import connectors
from weftline.settings import JobSettings

# Numbers come first in the keys of joins and groups: few applications have many executions, and sorts look at the first key first.
STATEMENT = ["root_execution_id", "app_id", "tag"]
EDGE_KEYS = ["app_id", "execution_id", "query_id", "batch_id", "command_pos", "command"]
STREAM_PRIORITY = 6
NO_COMMAND = 9
PLAIN_DEFINITIONS = [pt.CREATE_TABLE, pt.CREATE_SOURCE_TABLE]


def _priority(command: Column) -> Column:
    """A statement may log nested executions; the one that names the final target wins."""
    return (
        F.when(command.isin(pt.CTAS_HIVE, pt.CTAS_SOURCE), 1)
        .when(command == pt.SAVE_SOURCE, 2)
        .when(command == pt.CREATE_VIEW, 3)
        .when(command.isin(*pt.DIR_COMMANDS), 4)
        .otherwise(5)
    )


def _tag(pos: Column) -> Column:
    """A plan with several commands keeps their leaves apart; otherwise all leaves of a statement go together."""
    own = F.concat(F.col("execution_id").cast("string"), F.lit(":"), pos.cast("string"))
    return F.when(F.size("commands") > 1, own).otherwise("all")


def parse(executions: DataFrame) -> DataFrame:
    """Executions with their plan as arrays: ``nodes`` and ``commands``; the text column is dropped.

    Left out of ``commands``: temporary views, directory inserts that are not the root of the plan,
    and commands below another command.
    """
    root_depth = F.when(F.try_element_at("nodes", F.lit(1))["node"] == "AdaptiveSparkPlan", 1).otherwise(0)

    def counts(c: Column) -> Column:
        temporary = (c["command"] == pt.CREATE_VIEW) & ~pt.is_persisted_view(c["arguments"])
        nested_dir = c["command"].isin(*pt.DIR_COMMANDS) & (c["depth"] > root_depth)
        inside = F.exists("all_commands", lambda o: (o["pos"] < c["pos"]) & (o["end"] > c["pos"]))
        return ~temporary & ~nested_dir & ~inside

    return (
        executions.withColumn("parts", pt.paragraphs(F.col("plan")))
        .withColumn("raw_nodes", pt.plan_nodes(F.col("parts")))
        .withColumn("nodes", pt.mark_leaves(F.col("raw_nodes")))
        .withColumn("all_commands", pt.commands(F.col("nodes")))
        .withColumn("commands", F.filter("all_commands", counts))
        .drop("plan", "parts", "raw_nodes", "all_commands")
    )


def plan_nodes(executions: DataFrame) -> DataFrame:
    """One row per plan node."""
    nodes = parse(executions).select("app_id", "execution_id", "root_execution_id", F.inline_outer("nodes"))
    return nodes.where("pos is not null")


def facts(executions: DataFrame, *keep: str) -> DataFrame:
    """One row per execution: its best priority, its commands, its leaves, and the columns to ``keep``.

    Executions without commands stay in with the worst priority. A filter on the parsed arrays would
    be pushed below the parse and make Spark parse every plan again inside the filter.
    """
    simple = F.forall(
        F.filter("nodes", lambda n: ~n["is_leaf"] & (n["pos"] > 0)),
        lambda n: n["node"].isin(pt.CREATE_VIEW, "Project", "SubqueryAlias"),
    )
    listed = F.transform(
        "commands",
        lambda c: F.struct(
            c["pos"].alias("command_pos"),
            c["command"].alias("command"),
            c["arguments"].alias("arguments"),
            _tag(c["pos"]).alias("tag"),
            simple.alias("simple_shape"),
        ),
    )
    best = F.array_min(F.transform("commands", lambda c: _priority(c["command"])))

    def kinded(n: Column) -> Column:
        return F.struct(n["pos"].alias("pos"), n["node"].alias("node"), n["detail"].alias("detail"), pt.leaf_kind(n["node"], n["detail"]).alias("kind"), pt.locations(n["detail"]).alias("listed"))

    def counted(n: Column) -> Column:
        return once(pt.more_paths(n["listed"]), lambda more: n.withField("more", more).withField("mark", pt.list_mark(n["listed"], more)))

    locations = F.col("locations") if "locations" in executions.columns else F.array().cast("array<string>")

    def leaf(n: Column, before: Column) -> Column:
        whole = F.when((n["kind"] == "files") & (n["more"] != ""), pt.whole_list(n["mark"], F.col("marks"), before, locations))
        owner = F.filter("commands", lambda c: (c["pos"] < n["pos"]) & (c["end"] > n["pos"]))

        def told(whole: Column) -> Column:
            return F.struct(
                _tag(F.coalesce(F.try_element_at(owner, F.lit(1))["pos"], F.lit(-1))).alias("tag"),
                n["pos"].alias("leaf_pos"),
                n["node"].alias("node"),
                n["kind"].alias("kind"),
                F.when(n["kind"] == "connector", pt.leaf_connector(n["node"], n["detail"])).alias("connector"),
                ((n["kind"] == "files") & (n["more"] != "") & whole.isNull()).alias("shortened"),
                leaf_targets(n, whole).alias("targets"),
            )

        return once(whole, told)

    parsed = parse(executions).withColumn("found", F.transform(F.transform(F.filter("nodes", lambda n: n["is_leaf"]), kinded), counted))
    parsed = parsed.withColumn("marks", F.transform("found", lambda n: F.coalesce(n["mark"], F.lit(""))))
    return parsed.select(
        "app_id",
        "root_execution_id",
        "execution_id",
        "query_id",
        "batch_id",
        *keep,
        F.coalesce(best, F.lit(NO_COMMAND)).alias("priority"),
        listed.alias("listed"),
        F.transform("found", leaf).alias("leaves"),
    )


def beside(others: DataFrame, known: DataFrame, wanted: list[str]) -> DataFrame:
    """Those of ``others`` that belong to a statement which has one of the ``wanted`` commands in ``known``, the facts of the executions whose
    plan names one.

    Which execution speaks for a statement, and what the statement reads, is told by all its executions, so these must be parsed too. Beside a
    root only nested executions can be others; roots are others only where a nested execution has the command, so that mostly no root's text
    is shuffled."""
    keys = ["root_execution_id", "app_id"]
    nested = F.col("execution_id") != F.col("root_execution_id")
    having = known.where(F.exists("listed", lambda c: c["command"].isin(*wanted))).select(*keys, nested.alias("inner"))
    found = others.where(nested).join(having.select(*keys).distinct(), keys, "left_semi")
    inner = having.where("inner").select(*keys).distinct()
    if not inner.isEmpty():
        found = found.unionByName(others.where(~nested).join(inner, keys, "left_semi"))
    return found.select(*others.columns)


def stream_sink_rows(known: DataFrame, progress: DataFrame) -> DataFrame:
    """The same rows for finished micro-batches: the progress record names the sink.

    Their priority lies below any command, so they count only where the plan shows no write.
    """
    top = (F.col("execution_id") == F.col("root_execution_id")) & F.col("query_id").isNotNull()
    batches = known.where(top).select("app_id", "root_execution_id", "execution_id", "query_id", "batch_id")
    sinks = progress.select("app_id", "query_id", "batch_id", "sink_description")
    sink = F.struct(
        F.lit(-1).alias("command_pos"),
        F.lit(pt.STREAM_SINK).alias("command"),
        F.col("sink_description").alias("arguments"),
        F.lit("all").alias("tag"),
        F.lit(True).alias("simple_shape"),
    )
    return batches.join(sinks, ["batch_id", "query_id", "app_id"]).select(
        "app_id",
        "root_execution_id",
        "execution_id",
        "query_id",
        "batch_id",
        F.lit(STREAM_PRIORITY).alias("priority"),
        F.array(sink).alias("listed"),
    )


def chosen_commands(rows: DataFrame) -> DataFrame:
    """One row per command of the execution that speaks for its statement."""
    best = F.min(F.struct("priority", "execution_id", "query_id", "batch_id", "listed")).alias("best")
    return (
        rows.groupBy("root_execution_id", "app_id")
        .agg(best)
        .select(
            "app_id",
            "root_execution_id",
            "best.execution_id",
            "best.query_id",
            "best.batch_id",
            F.inline("best.listed"),
        )
    )


def leaf_rows(known: DataFrame) -> DataFrame:
    """One row per plan leaf with its kind, what it reads, and the command it feeds."""
    # The outer form, because for the inner one Spark infers a filter on the array and pushes it
    # below the parse, where it would parse every plan again.
    leaves = known.select("app_id", "execution_id", "root_execution_id", F.inline_outer("leaves"))
    return leaves.where("leaf_pos is not null")


def unknown_leaves(leaves: DataFrame, chosen: DataFrame) -> DataFrame:
    """Leaves of harvested statements no rule knows; they give no input and are reported, not guessed."""
    unknown = leaves.where("kind = 'unknown'")
    return unknown.join(chosen.select(*STATEMENT), STATEMENT, "left_semi").select(
        "app_id", "execution_id", "leaf_pos", "node"
    )


def sink_path(description: Column) -> Column:
    """Path a file sink prints between its brackets; null for console and other sinks."""
    path = F.regexp_extract(description, r"\[(.*?)\]", 1)
    return F.when(description.contains("FileSink"), path)


def leaf_targets(n: Column, whole: Column) -> Column:
    """What a leaf reads, as an array of targets; null for leaves that are neither table nor files."""
    nothing = F.lit(None).cast("string")
    table = F.array(pt.target(pt.leaf_table(n["node"], n["detail"]), nothing))
    files = F.transform(pt.leaf_paths(n["listed"], n["more"], whole), lambda p: F.struct(nothing.alias("db"), nothing.alias("table"), p.alias("path")))
    return F.when(n["kind"] == "table", table).when(n["kind"] == "files", files)


def input_targets(chosen: DataFrame, leaves: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Tables and files the leaves of a statement read."""
    command = F.col("command")
    reading = chosen.where(~command.isin(pt.LOAD_DATA, *PLAIN_DEFINITIONS))
    if settings.strict_view:
        reading = reading.where((command != pt.CREATE_VIEW) | F.col("simple_shape"))
    known = leaves.where("targets is not null").select(*STATEMENT, "leaf_pos", "targets")
    span = F.lit(1 << 40).cast("bigint")
    return (
        reading.select(*EDGE_KEYS, "root_execution_id", "tag")
        .join(known, STATEMENT)
        .select(*EDGE_KEYS, "leaf_pos", F.posexplode("targets").alias("nth", "target"))
        .select(
            *EDGE_KEYS,
            F.lit("input").alias("direction"),
            (F.col("leaf_pos") * span + F.col("nth")).alias("ordinal"),
            "target.*",
        )
    )


def command_targets(chosen: DataFrame) -> DataFrame:
    """The table or path each command writes, and the path a load reads."""
    command, arguments = F.col("command"), F.col("arguments")
    path = F.when(command == pt.STREAM_SINK, sink_path(arguments)).otherwise(pt.command_path(command, arguments))
    nothing = F.lit(None).cast("string")

    def way(direction: str, target: Column) -> Column:
        return F.struct(F.lit(direction).alias("direction"), F.lit(0).cast("bigint").alias("ordinal"), target.alias("target"))

    named = chosen.where(~command.isin(*PLAIN_DEFINITIONS)).select(
        *EDGE_KEYS, pt.command_table(command, arguments).alias("ident"), path.alias("path")
    )
    written = way("output", pt.target(F.col("ident"), F.col("path")))
    loaded = way("input", pt.target(nothing, F.col("path")))
    ways = F.when(command == pt.LOAD_DATA, F.array(way("output", pt.target(F.col("ident"), nothing)), loaded)).when(
        F.col("ident").isNotNull() | F.col("path").isNotNull(), F.array(written)
    )
    # The outer form, as in ``leaf_rows``.
    return named.select(*EDGE_KEYS, F.inline_outer(ways)).where("direction is not null").select(*EDGE_KEYS, "direction", "ordinal", "target.*")


def identify(applications: DataFrame, targets: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Turn ``db, table, path`` into ``type_name, qualified_name``; tables follow their application's catalog."""
    db = names.database_identifier(F.col("db"), settings)
    table = names.identifier(F.col("table"), settings)
    uri = F.col("uri")
    remote = F.coalesce("remote_hms", F.lit(False))
    prefix = F.coalesce("prefix", F.concat("app_id", F.lit(".")))
    own = names.table_name(prefix, db, table)
    return (
        targets.join(applications.select("app_id", "prefix", "remote_hms"), "app_id", "left")
        .withColumn("uri", paths.resolve(F.col("path"), settings))
        .withColumn("plain", paths.plain_path(uri))
        .withColumn(
            "type_name",
            F.when(F.col("table").isNull(), paths.path_type(uri))
            .when(remote, names.HIVE_TABLE)
            .otherwise(names.SPARK_TABLE),
        )
        .withColumn(
            "qualified_name",
            F.when(F.col("table").isNull(), paths.path_qualified_name(uri, F.col("plain")))
            .when(remote, names.hive_name(db, table, F.lit(settings.cluster)))
            .otherwise(own),
        )
        .drop("prefix", "remote_hms", "uri", "plain")
    )


def connector_edges(
    chosen: DataFrame, leaves: DataFrame, options: DataFrame, settings: JobSettings = JobSettings()
) -> DataFrame:
    """Edges from connector options, for plans that show a connector leaf or a connector write.

    A leaf that names its connector takes the options of that connector only."""
    found = connectors.datasets(options, settings).withColumnRenamed("execution_id", "options_execution_id")
    readers = (
        leaves.where("kind = 'connector'")
        .select(*STATEMENT, F.col("execution_id").alias("options_execution_id"), F.lit("input").alias("direction"), F.col("connector").alias("shown"))
        .distinct()
    )
    reading = chosen.select(*EDGE_KEYS, "root_execution_id", "tag").join(readers, STATEMENT)
    writing = chosen.where(F.col("command").isin(pt.SAVE_SOURCE, "WriteToDataSourceV2", pt.STREAM_SINK)).select(
        *EDGE_KEYS, F.col("execution_id").alias("options_execution_id"), F.lit("output").alias("direction"), F.lit(None).cast("string").alias("shown")
    )
    wanted = reading.select(*EDGE_KEYS, "options_execution_id", "direction", "shown").unionByName(writing)
    met = wanted.join(found, ["options_execution_id", "app_id", "direction"])
    return met.where("shown is null or shown = connector").select(
        *EDGE_KEYS, "direction", "type_name", "qualified_name", (F.lit(1 << 62) + F.col("nth")).alias("ordinal")
    )


def defined_tables(chosen: DataFrame) -> DataFrame:
    """Tables a statement defines or writes; a plain definition gives a table but no process."""
    ident = pt.command_table(F.col("command"), F.col("arguments"))
    return (
        chosen.withColumn("ident", ident)
        .where("ident is not null")
        .select(
            "app_id",
            "execution_id",
            "command",
            pt.identifier_db(F.col("ident")).alias("db"),
            pt.identifier_table(F.col("ident")).alias("table"),
        )
    )


def _no_location() -> Column:
    command = F.col("command")
    return command.isin(*pt.DIR_COMMANDS) & pt.command_path(command, F.col("arguments")).isNull()


def rejected(chosen: DataFrame, leaves: DataFrame) -> DataFrame:
    """Statements whose plan text lacks something the edges need."""
    lost = chosen.where(_no_location()).select(
        "app_id", "execution_id", F.lit("no location").alias("reason"), F.col("arguments").alias("detail")
    )
    shortened = leaves.where("kind = 'files' and shortened").select(
        "app_id", "execution_id", F.lit("shortened file list").alias("reason"), F.col("node").alias("detail")
    )
    return lost.unionByName(shortened)


def bad_records(chosen: DataFrame, leaves: DataFrame, options: DataFrame, malformed: DataFrame) -> DataFrame:
    """All that could not be read or matched, in one table: ``app_id, execution_id, reason, detail``."""
    unknown = unknown_leaves(leaves, chosen).select("app_id", "execution_id", F.lit("unknown leaf").alias("reason"), F.col("node").alias("detail"))
    parts = [rejected(chosen, leaves), unknown, connectors.rejected(options), connectors.without_options(leaves, chosen, options), malformed]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def statements(known: DataFrame, progress: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(commands, leaves)`` of all statements. Progress records add the sinks plans do not show."""
    rows = known.drop("leaves")
    if progress is not None:
        rows = rows.unionByName(stream_sink_rows(known, progress))
    return chosen_commands(rows), leaf_rows(known)


def process_edges(
    known: DataFrame,
    applications: DataFrame,
    options: DataFrame | None = None,
    progress: DataFrame | None = None,
    settings: JobSettings = JobSettings(),
) -> DataFrame:
    """All edges of all statements in ``facts``, before cycle cleaning; a dataset read twice gives one edge.

    A directory insert without a location fails as a whole, so none of its inputs are kept.
    """
    return edges_of(*statements(known, progress), applications, options, settings)


def edges_of(chosen: DataFrame, leaves: DataFrame, applications: DataFrame, options: DataFrame | None = None, settings: JobSettings = JobSettings()) -> DataFrame:
    """The same from ``statements``, for jobs that wrote the commands: they are read several times, and each time chosen again if not written."""
    chosen = chosen.where(~_no_location())
    targets = input_targets(chosen, leaves, settings).unionByName(command_targets(chosen))
    columns = [*EDGE_KEYS, "direction", "type_name", "qualified_name"]
    edges = identify(applications, targets, settings).select(*columns, "ordinal")
    if options is not None:
        edges = edges.unionByName(connector_edges(chosen, leaves, options, settings))
    return edges.groupBy(*columns).agg(F.min("ordinal").alias("ordinal"))
