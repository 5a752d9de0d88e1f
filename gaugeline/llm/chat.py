"""Tool calls of conversations: linking, order, argument checks, canonical JSON.

DataFrame functions only. Calls meet their results by (conversation, identifier), so the
rows of one huge conversation are spread like any others; nothing is gathered by
conversation. Arguments are variants, whose objects list their fields in order of name:
written out again they are canonical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gaugeline.session import materialise, scratch_dir

KEY = ["conv_id", "call_id"]
SCHEMA_FIELDS = (
    "name string, field string, kind string, required boolean, "
    "least double, most double, longest int"
)


def schema_table(spark: SparkSession, schemas: dict[str, dict[str, dict]]) -> DataFrame:
    """Rows of {function: {field: {kind, required, least, most, longest}}}.

    Kinds are string, integer, number, boolean, array and object.
    """
    parts = ("kind", "required", "least", "most", "longest")
    rows = [
        (name, field, *(rule.get(part) for part in parts))
        for name, fields in schemas.items()
        for field, rule in fields.items()
    ]
    return spark.createDataFrame(rows, SCHEMA_FIELDS)


def canonical(json: str) -> Column:
    """JSON with fields in order of name and no blanks; NULL if malformed."""
    return F.to_json(F.try_parse_json(json))


def _kind(value: str) -> Column:
    """JSON kind of a variant."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "STRING", "string")
        .when(kind == "BIGINT", "integer")
        .when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "number")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .otherwise("null")
    )


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, errors) of calls that break their function's schema.

    Errors are words like missing:limit, in order. ``calls``: one row for each key.
    """
    parsed = calls.select(*KEY, "name", F.try_parse_json("arguments").alias("given"))
    is_object = F.coalesce(F.schema_of_variant("given").startswith("OBJECT"), F.lit(False))
    broken = parsed.where(~is_object).select(*KEY, F.lit("arguments").alias("error"))
    sound = parsed.where(is_object)
    spark = calls.sparkSession
    fields = sound.lateralJoin(spark.tvf.variant_explode(F.col("given").outer())).select(
        *KEY,
        F.col("key").alias("field"),
        _kind("value").alias("found"),
        F.try_variant_get("value", "$", "double").alias("number"),
        F.char_length(F.try_variant_get("value", "$", "string")).alias("size"),
    )
    known = schemas.select("name").distinct().withColumn("known", F.lit(True))
    unknown = (
        sound.join(known, "name", "left").where("known is null").select(*KEY, F.lit("function").alias("error"))
    )
    expected = sound.select(*KEY, "name").join(schemas, "name").drop("name")
    named = sound.join(known, "name").select(*KEY)
    fields = fields.join(named, KEY, "left_semi")
    right_kind = (F.col("found") == F.col("kind")) | (
        (F.col("kind") == "number") & (F.col("found") == "integer")
    )
    wrong = (
        F.when(F.col("kind").isNull(), "unexpected")
        .when(F.col("found").isNull(), F.when(F.col("required"), "missing"))
        .when(~right_kind, "kind")
        .when((F.col("number") < F.col("least")) | (F.col("number") > F.col("most")), "range")
        .when((F.col("kind") == "string") & (F.col("size") > F.col("longest")), "length")
    )
    checked = (
        expected.join(fields, [*KEY, "field"], "full")
        .select(*KEY, F.concat(wrong, F.lit(":"), "field").alias("error"))
        .where("error is not null")
    )
    return (
        checked.union(broken).union(unknown).groupBy(*KEY).agg(F.array_sort(F.collect_set("error")).alias("errors"))
    )


def levels(edges: DataFrame) -> DataFrame:
    """Topological levels of (conv_id, call_id, needs): one row for each call that needs any.

    Level n needs a call of level n - 1; it is NULL where a call needs itself in the end,
    or one that does. ``needs`` names known calls.

    Calls with one need form chains, which are contracted first: each jumps to what its
    need has jumped to, so a chain of n calls takes log n rounds. What is left are the
    calls with several needs; they settle one level of them a round. Every round is
    written, so plans do not grow with depth.
    """
    edges = materialise(edges.distinct(), "chat-needs")
    counts = edges.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("needs").alias("end"))
    kinds = counts.select("conv_id", F.col("call_id").alias("end"), (F.col("n") == 1).alias("goes_on"))
    jumps = materialise(
        counts.where("n = 1")
        .drop("n")
        .join(kinds, ["conv_id", "end"], "left")
        # What a chain ends at: a call without needs (NULL) or one with several (false).
        .select(*KEY, "end", F.lit(1).alias("length"), "goes_on"),
        "chat-jumps",
    )
    left = jumps.where("goes_on").count()
    while left:
        over = jumps.select(
            "conv_id",
            F.col("call_id").alias("end"),
            F.col("end").alias("next"),
            F.col("length").alias("more"),
            F.col("goes_on").alias("still"),
        )
        moved = jumps.where("goes_on").join(over, ["conv_id", "end"])
        jumps = materialise(
            moved.select(
                *KEY,
                F.col("next").alias("end"),
                (F.col("length") + F.col("more")).alias("length"),
                F.col("still").alias("goes_on"),
            ).union(jumps.where("goes_on is null or not goes_on")),
            "chat-jumps",
        )
        before, left = left, jumps.where("goes_on").count()
        if left == before:  # all that go on go round
            break
    chained = jumps.where("goes_on is null").select(*KEY, F.col("length").alias("level"))
    round_ = jumps.where("goes_on").select(*KEY, F.lit(None).cast("int").alias("level"))
    several = counts.where("n > 1").select(*KEY)
    if several.isEmpty():
        return chained.union(round_)
    settled = _settled(edges, jumps, several)
    ends = settled.select("conv_id", F.col("call_id").alias("end"), F.col("level").alias("base"))
    hanging = jumps.where("not goes_on").join(ends, ["conv_id", "end"], "left")
    return (
        chained.union(round_)
        .union(hanging.select(*KEY, F.col("length") + F.col("base")))
        .union(several.join(settled, KEY, "left"))
    )


def _settled(edges: DataFrame, jumps: DataFrame, several: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the calls with several needs that do not go round."""
    to_chain = jumps.select(
        "conv_id", F.col("call_id").alias("needs"), F.col("end").alias("anchor"), "length", "goes_on"
    )
    to_several = several.select("conv_id", F.col("call_id").alias("needs"), F.lit(True).alias("waits"))
    chain = F.col("length").isNotNull()
    anchor = (
        F.when(F.col("waits"), F.col("needs"))
        # A chain that goes round is waited for in vain: by its own name.
        .when(F.col("goes_on"), F.col("needs"))
        .when(chain & F.col("goes_on").isNotNull(), F.col("anchor"))
    )
    open_edges = materialise(
        edges.join(several, KEY, "left_semi")
        .join(to_chain, ["conv_id", "needs"], "left")
        .join(to_several, ["conv_id", "needs"], "left")
        .select(*KEY, anchor.alias("anchor"), (F.coalesce("length", F.lit(0)) + 1).alias("height"))
        .groupBy(*KEY, "anchor")
        .agg(F.max("height").alias("height")),
        "chat-waiting",
    )
    spark, path = edges.sparkSession, scratch_dir(edges.sparkSession, "chat-settled")
    schema = StructType([*several.schema.fields, StructField("level", IntegerType())])
    spark.createDataFrame([], schema).write.parquet(path)
    while True:
        ready = materialise(
            open_edges.groupBy(*KEY)
            .agg(F.max("height").cast("int").alias("level"), F.count("anchor").alias("waits"))
            .where("waits = 0")
            .drop("waits"),
            "chat-ready",
        )
        if ready.isEmpty():
            return spark.read.schema(schema).parquet(path)
        ready.write.mode("append").parquet(path)
        bases = ready.select("conv_id", F.col("call_id").alias("anchor"), F.col("level").alias("base"))
        rest = open_edges.join(ready, KEY, "left_anti").join(bases, ["conv_id", "anchor"], "left")
        open_edges = materialise(
            rest.select(
                *KEY,
                F.when(F.col("base").isNull(), F.col("anchor")).alias("anchor"),
                (F.col("height") + F.coalesce("base", F.lit(0))).alias("height"),
            )
            .groupBy(*KEY, "anchor")
            .agg(F.max("height").alias("height")),
            "chat-waiting",
        )


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Every call and every result as a message, linked, ordered and checked.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON), needs (identifiers of calls
    that must come first); ``results``: conv_id, call_id, turn, content. Columns: conv_id,
    call_id, turn, level, status, valid, errors, message. Order by conv_id, level, turn.

    status is linked, unanswered, cycle (needs itself in the end), repeated (a call or
    result whose identifier an earlier turn used) or orphan (a result without call).
    A call is valid if it is linked and breaks no rule. needs of unknown calls are ignored.
    Rows without conv_id or call_id link to nothing. Of several rows of one turn and
    identifier the smallest content counts as first. No rows give no rows.
    """
    calls = calls.select(*KEY, "turn", "name", "arguments", "needs")
    results = results.select(*KEY, "turn", "content")
    keyed = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    body = F.struct("turn", "name", "arguments", "needs")
    groups = calls.where(keyed).groupBy(*KEY).agg(F.min(body).alias("call"), F.count("*").alias("n"))
    firsts = materialise(groups.select(*KEY, "call.*", "n"), "chat-calls")
    answer = F.struct("turn", "content")
    answers = (
        results.where(keyed).groupBy(*KEY).agg(F.min(answer).alias("answer"), F.count("*").alias("answers"))
    )
    wanted = firsts.select(*KEY, F.explode("needs").alias("needs"))
    known = firsts.select("conv_id", F.col("call_id").alias("needs"))
    above = levels(wanted.join(known, ["conv_id", "needs"], "left_semi"))
    joined = firsts.join(answers, KEY, "full").join(argument_errors(firsts, schemas), KEY, "left")
    round_ = F.when(F.col("level").isNull(), True).alias("cyclic")
    joined = joined.join(above.select(*KEY, "level", round_), KEY, "left")
    called = F.col("n").isNotNull()
    status = (
        F.when(~called, "orphan")
        .when(F.col("cyclic"), "cycle")
        .when(F.col("answers").isNull(), "unanswered")
        .otherwise("linked")
    )
    message = F.when(
        called,
        _json(
            arguments=F.coalesce(F.try_parse_json("arguments"), F.col("arguments").cast("variant")),
            id=F.col("call_id"),
            name=F.col("name"),
            result=F.col("answer.content"),
            turn=F.col("turn"),
        ),
    ).otherwise(_json(id=F.col("call_id"), result=F.col("answer.content"), turn=F.col("answer.turn")))
    linked = joined.withColumn("status", status).select(
        *KEY,
        F.coalesce("turn", "answer.turn").alias("turn"),
        F.when(called & F.col("cyclic").isNull(), F.coalesce("level", F.lit(0))).alias("level"),
        "status",
        ((F.col("status") == "linked") & F.col("errors").isNull()).alias("valid"),
        F.array_join("errors", ",").alias("errors"),
        message.alias("message"),
    )
    # What the first rows of their identifiers leave over.
    later_calls = _later(calls, keyed, body).select(
        *KEY,
        "turn",
        *_unlinked(keyed),
        _json(arguments=F.col("arguments"), id=F.col("call_id"), name=F.col("name"), turn=F.col("turn")).alias("message"),
    )
    later_results = _later(results, keyed, answer).select(
        *KEY,
        "turn",
        *_unlinked(keyed),
        _json(id=F.col("call_id"), result=F.col("content"), turn=F.col("turn")).alias("message"),
    )
    return linked.union(later_calls).union(later_results)


def _json(**fields: Column) -> Column:
    """A JSON object with its fields in order of name."""
    return F.to_json(
        F.struct(*[fields[name].alias(name) for name in sorted(fields)]), {"ignoreNullFields": "false"}
    )


def _unlinked(keyed: Column) -> list[Column]:
    return [
        F.lit(None).cast("int").alias("level"),
        F.when(keyed, "repeated").otherwise("orphan").alias("status"),
        F.lit(False).alias("valid"),
        F.lit(None).cast("string").alias("errors"),
    ]


def _later(rows: DataFrame, keyed: Column, body: Column) -> DataFrame:
    """Rows without a key, and of each key all but its first; equal rows are counted out."""
    names = rows.columns
    counted = rows.where(keyed).groupBy(*names).agg(F.count("*").alias("_n"))
    several = counted.groupBy(*KEY).agg(F.min(body).alias("_first"), F.sum("_n").alias("_all")).where("_all > 1")
    first = body.eqNullSafe(F.col("_first"))
    rest = (
        counted.join(several, KEY)
        .withColumn("_n", F.col("_n") - F.when(first, 1).otherwise(0))
        .where("_n > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    )
    return rest.select(*names).union(rows.where(~keyed))


def plain_messages(turns: DataFrame) -> DataFrame:
    """Turns that are neither calls nor results, as messages of the same columns."""
    return turns.select(
        "conv_id",
        F.lit(None).cast("string").alias("call_id"),
        "turn",
        F.lit(0).alias("level"),
        F.lit("message").alias("status"),
        F.lit(True).alias("valid"),
        F.lit(None).cast("string").alias("errors"),
        _json(role=F.col("role"), text=F.col("text"), turn=F.col("turn")).alias("message"),
    )
