"""Reading a printed physical plan with array expressions, one row per plan and no shuffle.

A printed plan is a header tree (one line per node, indented three characters per level, each line
ending in ``(n)``) followed by one ``(n) Node`` paragraph per node. Everything that depends on how
Spark words a plan is in the pattern constants below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.values import once

# Node and command names as Spark prints them.
INSERT_HIVE = "InsertIntoHiveTable"
INSERT_FS = "InsertIntoHadoopFsRelationCommand"
CTAS_HIVE = "CreateHiveTableAsSelectCommand"
CTAS_SOURCE = "CreateDataSourceTableAsSelectCommand"
CREATE_TABLE = "CreateTableCommand"
CREATE_SOURCE_TABLE = "CreateDataSourceTableCommand"
CREATE_VIEW = "CreateViewCommand"
LOAD_DATA = "LoadDataCommand"
SAVE_SOURCE = "SaveIntoDataSourceCommand"
INSERT_HIVE_DIR = "InsertIntoHiveDirCommand"
INSERT_SOURCE_DIR = "InsertIntoDataSourceDirCommand"
V2_WRITES = ["WriteToDataSourceV2", "AppendData", "OverwriteByExpression", "OverwritePartitionsDynamic"]
STREAM_SINK = "StreamSink"

WRITE_COMMANDS = [INSERT_HIVE, INSERT_FS, CTAS_HIVE, CTAS_SOURCE]
EXECUTED_COMMANDS = [LOAD_DATA, CREATE_VIEW, SAVE_SOURCE, CREATE_TABLE, CREATE_SOURCE_TABLE]
DIR_COMMANDS = [INSERT_HIVE_DIR, INSERT_SOURCE_DIR]
COMMANDS = WRITE_COMMANDS + EXECUTED_COMMANDS + DIR_COMMANDS

_EXECUTE = "Execute "
_PARAGRAPH_START = r"\n\n+(?=\(\d+\) )"
_TREE_PREFIX = r"^((?:[ :]  )*(?:[+:]- )?)"
_NODE_NUMBER = r"\((\d+)\)\s*$"

# A quoted identifier such as `spark_catalog`.`db`.`t`.
IDENTIFIER = r"(`[^`]+`(?:\.`[^`]+`){0,2})"
_SAVE_MODE_TABLE = r"(?:Append|Overwrite|ErrorIfExists|Ignore), " + IDENTIFIER
_INSERT_PATH = r"Arguments: (.*?), (?:true|false), "
_LOAD_PATH = r"Arguments: `[^,]*, (.*?), (?:true|false), (?:true|false)"
_STORAGE_LOCATION = r"Location: ([^,)\n]+)"
_SCAN_TABLE = r"^Scan \S+ ([^\s(]+)$"
_SCAN_LOCATIONS = r"Location: \w+ ?\[([^\]]*)\]"
_CUT = r", \.\.\. (\d+) entries$"
_SCAN_RELATION = r"^(?:Scan|BatchScan|MicroBatchScan) (.*)$"


def paragraphs(plan: Column) -> Column:
    """Header and node paragraphs. Put them in a column of their own: the expressions below use them per node."""
    return F.split(plan, _PARAGRAPH_START)


def header(plan: Column) -> Column:
    return _tree(F.element_at(paragraphs(plan), 1))


def _tree(top: Column) -> Column:
    """The header tree without its title line and without a trailing initial-plan copy."""
    return F.substring_index(F.regexp_replace(top, r"^== Physical Plan ==\n", ""), "+- == Initial Plan ==", 1)


def plan_nodes(parts: Column) -> Column:
    """``array<struct<pos,depth,node_id,node,detail>>`` of the paragraphs of a plan, in print order."""
    lines = F.filter(F.split(_tree(F.element_at(parts, 1)), "\n"), lambda x: x.rlike(_NODE_NUMBER))

    def node(line: Column, pos: Column, indent: Column, number: Column) -> Column:
        title = F.substr(line, indent + 1)
        title = F.when(title.startswith("* "), F.substr(title, F.lit(3))).otherwise(title)
        # Paragraph k describes node k, so it sits right after the header; look it up if it does not.
        mark = F.concat(F.lit("("), number.cast("string"), F.lit(") "))
        found = once(
            F.try_element_at(parts, number + 1),
            lambda near: F.when(near.startswith(mark), near).otherwise(F.try_element_at(F.filter(parts, lambda p: p.startswith(mark)), F.lit(1))),
        )
        return F.struct(
            pos.alias("pos"),
            (indent / 3).cast("int").alias("depth"),
            number.alias("node_id"),
            F.rtrim(F.regexp_replace(title, _NODE_NUMBER, "")).alias("node"),
            F.substring_index(F.coalesce(found, F.lit("")), "\n\n=====", 1).alias("detail"),
        )

    def measured(line: Column, pos: Column) -> Column:
        indent = F.length(F.regexp_extract(line, _TREE_PREFIX, 1)).alias("indent")
        number = F.regexp_extract(line, _NODE_NUMBER, 1).cast("int").alias("number")
        return once(F.struct(indent, number), lambda m: node(line, pos, m["indent"], m["number"]))

    return F.transform(lines, measured)


def mark_leaves(nodes: Column) -> Column:
    """Add ``is_leaf``: a node is a leaf when the next printed node is not deeper."""
    return F.transform(
        nodes,
        lambda n, i: F.struct(
            n["pos"].alias("pos"),
            n["depth"].alias("depth"),
            n["node_id"].alias("node_id"),
            n["node"].alias("node"),
            n["detail"].alias("detail"),
            (F.coalesce(F.try_element_at(nodes, i + 2)["depth"], F.lit(-1)) <= n["depth"]).alias("is_leaf"),
        ),
    )


def command_of(node: Column) -> Column:
    """Command name of a node title, null for anything that does not write or define a dataset.

    A command that Spark executes eagerly is printed twice, as ``Execute X`` and as its child ``X``;
    only the first form counts.
    """
    def known(executed: Column) -> Column:
        return F.when(executed.isin(*COMMANDS), executed)

    bare = F.substring(node, len(_EXECUTE) + 1, (1 << 31) - 1)
    return F.when(node.startswith(_EXECUTE), once(F.substring_index(bare, " ", 1), known)).when(node.isin(*V2_WRITES), F.lit("WriteToDataSourceV2"))


def may_have(plan: Column, wanted: list[str]) -> Column:
    """Whether the text of a plan can hold one of the ``wanted`` commands, told without parsing it; see ``command_of``."""
    shown = [x for name in wanted for x in (V2_WRITES if name == V2_WRITES[0] else [_EXECUTE + name])]
    found = F.lit(False)
    for text in shown:
        found = found | plan.contains(text)
    return F.coalesce(found, F.lit(False))


def may_be_cut(plan: Column) -> Column:
    """Whether the text of a plan can hold a cut list of paths; see ``more_paths``."""
    return F.coalesce(plan.contains("Location: ") & plan.contains(", ... "), F.lit(False))


def commands(nodes: Column) -> Column:
    """Commands of a plan with the detail text that holds their arguments and the end of their subtree."""
    picked = F.filter(nodes, lambda n: command_of(n["node"]).isNotNull())

    def command(n: Column) -> Column:
        name = command_of(n["node"])
        child = F.try_element_at(nodes, n["pos"] + 2)
        after = F.filter(nodes, lambda m: (m["pos"] > n["pos"]) & (m["depth"] <= n["depth"]))
        return F.struct(
            n["pos"].alias("pos"),
            n["depth"].alias("depth"),
            name.alias("command"),
            F.when(child["node"] == name, child["detail"]).otherwise(n["detail"]).alias("arguments"),
            F.coalesce(F.try_element_at(after, F.lit(1))["pos"], F.size(nodes)).alias("end"),
        )

    return F.transform(picked, command)


def _or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _name_parts(ident: Column) -> Column:
    return F.split(F.replace(ident, F.lit("`"), F.lit("")), r"\.")


def _part(parts: Column, from_end: int) -> Column:
    return F.when(F.size(parts) >= from_end, F.try_element_at(parts, F.lit(-from_end)))


def identifier_db(ident: Column) -> Column:
    return once(_name_parts(ident), lambda parts: _part(parts, 2))


def identifier_table(ident: Column) -> Column:
    return once(_name_parts(ident), lambda parts: _part(parts, 1))


def target(ident: Column, path: Column) -> Column:
    """A table when there is one, else a path, as one struct."""

    def named(ident: Column) -> Column:
        def of(parts: Column) -> Column:
            return F.struct(_part(parts, 2).alias("db"), _part(parts, 1).alias("table"), F.when(ident.isNull(), path).alias("path"))

        return once(_name_parts(ident), of)

    return once(ident, named)


def command_table(command: Column, arguments: Column) -> Column:
    """Identifier of the table a command writes or defines; null when it writes a path or a connector."""
    first = F.regexp_extract(arguments, r"Arguments: \[?" + IDENTIFIER, 1)
    insert = F.regexp_extract(arguments, _SAVE_MODE_TABLE, 1)
    named = [INSERT_HIVE, CTAS_HIVE, CTAS_SOURCE, CREATE_TABLE, CREATE_SOURCE_TABLE, CREATE_VIEW, LOAD_DATA]
    return _or_null(F.when(command == INSERT_FS, insert).when(command.isin(*named), first))


def command_path(command: Column, arguments: Column) -> Column:
    """Path a command writes (or, for a load, reads)."""
    return _or_null(
        F.when(command == INSERT_FS, F.regexp_extract(arguments, _INSERT_PATH, 1))
        .when(command == LOAD_DATA, F.regexp_extract(arguments, _LOAD_PATH, 1))
        .when(command.isin(*DIR_COMMANDS), F.regexp_extract(arguments, _STORAGE_LOCATION, 1))
    )


def is_persisted_view(arguments: Column) -> Column:
    return arguments.contains(", PersistedView")


def leaf_kind(node: Column, detail: Column) -> Column:
    """``table``, ``files``, ``connector``, ``empty`` (reads nothing by design) or ``unknown``."""
    relation = F.regexp_extract(node, _SCAN_RELATION, 1)
    v1_relation = relation.rlike(r"^\S*(JDBC|HBase|Kafka|HiveWarehouse)\w*")
    logical = node.isin("LogicalRelation", "HiveTableRelation", "View")
    return (
        F.when(logical & detail.rlike(IDENTIFIER), "table")
        .when(logical & (node == "LogicalRelation"), F.when(detail.rlike("Arguments: (parquet|orc|csv|json|text|avro),"), "empty").otherwise("connector"))
        .when(v1_relation | node.startswith("BatchScan") | node.startswith("MicroBatchScan"), "connector")
        .when(node.rlike(_SCAN_TABLE), "table")
        .when(node.startswith("Scan ") & detail.contains("Location: "), "files")
        .when(node.isin("OneRowRelation", "Scan OneRowRelation", "ReusedExchange", "ReusedSubquery"), "empty")
        .when(command_of(node).isNotNull() | node.isin(*COMMANDS), "empty")
        .otherwise("unknown")
    )


def leaf_connector(node: Column, detail: Column) -> Column:
    """Connector that the text of a leaf names; null where it names none that is known."""
    shown = F.regexp_extract(F.concat_ws(" ", node, F.regexp_extract(detail, r"Arguments: (\w+)\(", 1)), "(JDBC|HBase|Kafka|HiveWarehouse)", 1)
    return F.when(shown == "JDBC", "jdbc").when(shown == "HBase", "hbase").when(shown == "Kafka", "kafka").when(shown == "HiveWarehouse", "hwc")


def leaf_table(node: Column, detail: Column) -> Column:
    printed = F.regexp_extract(node, _SCAN_TABLE, 1)
    quoted = F.regexp_extract(detail, IDENTIFIER, 1)
    return _or_null(F.when(node.startswith("Scan "), printed).otherwise(quoted))


def leaf_paths(listed: Column, more: Column, whole: Column) -> Column:
    """Paths a file scan lists, of its ``locations``. A printed plan shows the first of several; the others are those of ``whole``,
    the plan graph's list of this scan, where that is known; see ``whole_list``."""
    printed = F.filter(F.split(listed, ", "), lambda p: (F.length(p) > 0) & ~p.startswith("..."))
    inside = F.when(more != "", F.regexp_extract(whole, r"\[(.*)\]$", 1))
    return once(inside, lambda x: F.when(F.length(x) > 0, F.split(x, ", ")).otherwise(printed))


def locations(detail: Column) -> Column:
    """What a leaf prints between the brackets of its location; empty where it prints none."""
    return F.when(detail.contains("Location: "), F.regexp_extract(detail, _SCAN_LOCATIONS, 1)).otherwise("")


def more_paths(listed: Column) -> Column:
    """How many paths beyond the first a scan reads, as its ``locations`` say where they are cut; empty where they are whole."""
    return F.when(listed.contains(", ... "), F.regexp_extract(listed, _CUT, 1)).otherwise("")


def list_mark(listed: Column, more: Column) -> Column:
    """How the plan graph's list of a cut scan begins: with the number of paths and the first one."""
    count = (more.try_cast("int") + 1).cast("string")
    return F.when(more != "", F.concat(F.lit("("), count, F.lit(" paths)["), F.regexp_extract(listed, "^(.*?), ", 1), F.lit(", ")))


def whole_list(mark: Column, marks: Column, before: Column, locations: Column) -> Column:
    """Of ``locations``, the graph's lists in the order of its scans, that of one cut scan; null where it is cut itself or not known.

    ``marks`` are those of all leaves in the plan's order, ``before`` the number of leaves before this one. Scans that begin alike take the
    lists that do so one by one, as both are in the order of the tree. Where there are not as many lists as scans,
    which list is whose is not known, unless the lists are one."""
    alike = F.size(F.filter(marks, lambda m: m == mark))
    earlier = F.size(F.filter(F.slice(marks, F.lit(1), before), lambda m: m == mark))

    def one(found: Column) -> Column:
        lists, alike = found["lists"], found["alike"]
        same = (F.size(lists) > alike) & (F.size(F.array_distinct(lists)) == 1)
        return F.when(F.size(lists) == alike, F.get(lists, earlier)).when(same, F.get(lists, F.lit(0)))

    found = F.struct(F.filter(locations, lambda x: x.contains(mark)).alias("lists"), alike.alias("alike"))
    return once(once(found, one), lambda x: F.when(~x.endswith("...]"), x))
