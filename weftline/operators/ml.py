"""Machine-learning events: pipelines, models, and the processes that fit or apply them.

An event counts only if what it builds on was seen before it in the same application; the lookups
are as-of joins, so no state is kept and no application is folded in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import names, paths
from weftline.operators import asof, entities
from weftline.settings import JobSettings

QUERY = ["app_id", "execution_id", "command_pos"]
PAIR = ["app_id", "uid"]

# Fixed value: how a fit process describes itself.
FIT_DESCRIPTION = "Spark ML training model with pipeline uid: "


def _first_seen(events: DataFrame, event: str, out: str) -> DataFrame:
    return events.where(F.col("event") == event).groupBy(*PAIR).agg(F.min("seq").alias(out))


def pipeline_saves(events: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Saves of pipelines created before: ``app_id, seq, uid, pipeline_uri``."""
    created = _first_seen(events, "CreatePipeline", "created")
    saves = events.where("event = 'SavePipeline'").join(created, PAIR).where("seq > created")
    located = saves.select("app_id", "seq", "uid", paths.resolve(F.col("directory"), settings).alias("pipeline_uri"))
    return paths.with_plain(located, "pipeline_uri", "pipeline_plain")


def model_saves(events: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Saves of models whose pipeline was saved before, with that pipeline's directory and training data.

    ``has_model`` tells whether the model was created before; only then is there a model entity.
    """
    saves = events.where("event = 'SaveModel'").select(
        "app_id", "seq", "uid", paths.resolve(F.col("directory"), settings).alias("model_uri")
    )
    saves = paths.with_plain(saves, "model_uri", "model_plain")
    width = settings.asof_width
    payload = ["pipeline_uri", "pipeline_plain"]
    saved = asof.lookup(saves, pipeline_saves(events, settings), PAIR, "seq", "seq", payload, width, "p")
    training = events.where("event = 'CreatePipeline'").select(*PAIR, "seq", "dataset_execution_id")
    known = asof.lookup(saved.where("p is not null"), training, PAIR, "seq", "seq", ["dataset_execution_id"], width, "t")
    created = _first_seen(events, "CreateModel", "model_created")
    return known.join(created, PAIR, "left").select(
        "app_id",
        "seq",
        "uid",
        "model_uri",
        "model_plain",
        F.col("p.pipeline_uri").alias("pipeline_uri"),
        F.col("p.pipeline_plain").alias("pipeline_plain"),
        F.col("t.dataset_execution_id").alias("dataset_execution_id"),
        F.coalesce(F.col("model_created") < F.col("seq"), F.lit(False)).alias("has_model"),
    )


def graph(events: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Entities of saved pipelines and models with their directories, by event."""
    uri, plain = F.col("pipeline_uri"), F.col("pipeline_plain")
    model_uri, model_plain = F.col("model_uri"), F.col("model_plain")
    pipeline = entities.ml_entity(
        names.ML_PIPELINE, F.col("uid"), paths.path_type(uri), paths.path_qualified_name(uri, plain)
    )
    model = entities.ml_entity(
        names.ML_MODEL, F.col("uid"), paths.path_type(model_uri), paths.path_qualified_name(model_uri, model_plain)
    )
    of_pipelines = F.concat(entities.path_entities(uri, plain), F.array(pipeline))
    directories = F.concat(entities.path_entities(uri, plain), entities.path_entities(model_uri, model_plain))
    of_models = F.when(F.col("has_model"), F.concat(directories, F.array(model))).otherwise(directories)
    saved = pipeline_saves(events, settings).select("app_id", "seq", F.inline(of_pipelines))
    return saved.unionByName(model_saves(events, settings).select("app_id", "seq", F.inline(of_models)))


def _edge(direction: str, type_name: Column, qualified_name: Column) -> Column:
    return F.struct(
        F.lit(direction).alias("direction"),
        type_name.alias("type_name"),
        qualified_name.alias("qualified_name"),
    )


def _path_edge(direction: str, what: str) -> Column:
    uri = F.col(f"{what}_uri")
    return _edge(direction, paths.path_type(uri), paths.path_qualified_name(uri, F.col(f"{what}_plain")))


def _model_edge(direction: str, uid: Column) -> Column:
    return _edge(direction, F.lit(names.ML_MODEL), names.model_uid(uid))


def fit_edges(events: DataFrame, training_edges: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """Edges of fit processes: pipeline and training data in; model and both directories out.

    ``training_edges`` are input edges by ``app_id, execution_id``.
    """
    fits = model_saves(events, settings).where("has_model")
    own = F.array(
        _edge("input", F.lit(names.ML_PIPELINE), F.col("uid")),
        _model_edge("output", F.col("uid")),
        _path_edge("output", "model"),
        _path_edge("output", "pipeline"),
    )
    description = F.concat(F.lit(FIT_DESCRIPTION), F.col("uid")).alias("plan_description")
    known = fits.select("app_id", "seq", description, F.inline(own))
    read = training_edges.where("direction = 'input'").select(
        "app_id", F.col("execution_id").alias("dataset_execution_id"), "direction", "type_name", "qualified_name"
    )
    trained = fits.join(read, ["app_id", "dataset_execution_id"]).select(
        "app_id", "seq", description, "direction", "type_name", "qualified_name"
    )
    return known.unionByName(trained.distinct())


def modes(queries: DataFrame, events: DataFrame, settings: JobSettings = JobSettings()) -> DataFrame:
    """``queries`` with ``mode`` and the model in use.

    ``etl``: no model was applied before; ``fit``: one was, and a fit process came before; ``score``:
    one was, and none did; ``lost``: the applied model was never loaded, so the process cannot be built.
    """
    width = settings.asof_width
    applied = events.where("event = 'Transform'").select("app_id", "seq", F.col("uid").alias("model"))
    marked = asof.lookup(queries, applied, ["app_id"], "seq", "seq", ["model"], width, "a")
    marked = marked.withColumn("uid", F.col("a.model")).drop("a")
    loads = events.where("event = 'LoadModel'").select(
        *PAIR, "seq", paths.resolve(F.col("directory"), settings).alias("model_uri")
    )
    loads = paths.with_plain(loads, "model_uri", "model_plain")
    loaded = asof.lookup(marked, loads, PAIR, "seq", "seq", ["model_uri", "model_plain"], width, "l")
    fits = model_saves(events, settings).where("has_model").groupBy("app_id").agg(F.min("seq").alias("first_fit"))
    fitted = F.coalesce(F.col("first_fit") < F.col("seq"), F.lit(False))
    mode = (
        F.when(F.col("uid").isNull(), "etl")
        .when(F.col("l").isNull(), "lost")
        .when(fitted, "fit")
        .otherwise("score")
    )
    return (
        loaded.join(fits, "app_id", "left")
        .withColumn("mode", mode)
        .withColumn("model_uri", F.col("l.model_uri"))
        .withColumn("model_plain", F.col("l.model_plain"))
        .drop("l", "first_fit")
    )


def process_edges(
    edges: DataFrame, queries: DataFrame, events: DataFrame, settings: JobSettings = JobSettings()
) -> DataFrame:
    """Edges of all queries, those that applied a model in their machine-learning form.

    ``edges`` are cleaned edges with ``ordinal``; ``queries`` gives ``seq`` per ``app_id, execution_id``.
    The machine-learning form keeps the first input and the first output and adds the model; a query
    that lacks one of the two gives no process.
    """
    state = modes(queries.select("app_id", "execution_id", "seq"), events, settings)
    state = state.select("app_id", "execution_id", "mode", "uid", "model_uri", "model_plain")
    columns = [*QUERY, "mode", "direction", "type_name", "qualified_name"]
    moded = edges.join(state, ["app_id", "execution_id"])
    plain = moded.where("mode = 'etl'").select(*columns)

    def first(direction: str) -> Column:
        ranked = F.struct("ordinal", "type_name", "qualified_name")
        return F.min(F.when(F.col("direction") == direction, ranked))

    firsts = (
        moded.where("mode in ('fit', 'score')")
        .groupBy(*QUERY, "mode", "uid", "model_uri", "model_plain")
        .agg(first("input").alias("i"), first("output").alias("o"))
        .where("i is not null and o is not null")
    )
    both = F.array(
        _edge("input", F.col("i.type_name"), F.col("i.qualified_name")),
        _edge("output", F.col("o.type_name"), F.col("o.qualified_name")),
    )
    model = F.array(_path_edge("input", "model"), _model_edge("input", F.col("uid")))
    shaped = F.when(F.col("mode") == "score", F.concat(both, model)).otherwise(both)
    return plain.unionByName(firsts.select(*QUERY, "mode", F.inline(shaped)).select(*columns))
