"""Tool calls of conversations: linked with their results, ordered, validated and written as canonical JSON.

* *Linking.* Calls and results are joined on (conversation, call id). The first result by turn is the call's, each further one is a
  row of its own; a call without a result and a result without a call stay visible. If an id is called twice, the first call by turn
  owns it and the others are duplicates; of equal rows exactly one owns it.
* *Order.* A call may refer to earlier calls by id. Its level is 0 without references, else one more than the highest level it
  refers to. Calls with one reference find the end of their chain by pointer doubling, so a chain of a thousand calls takes ten
  rounds; calls with several settle one nesting of such calls a round. What is part of, or depends on, a cycle comes last.
  Within a level calls stand by turn and id. Positions are numbered over ranges, not in one task per conversation.
* *Validation.* Arguments must be one JSON object and nothing after it, with all required fields, each field of its declared type, and no
  others. A number is an integer by its value, however it is written. Schemas are a parameter; every fault is named.
* *Canonical JSON.* Keys sorted, no white space, one form of each number (``canonical_number``): calls that mean the same are the same text.

All of it is DataFrame expressions. Null ids or conversations link with nothing. Null arguments are malformed.
References to unknown calls are faults and do not order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.functions.once import computed_once
from newslake.operators.position import numbered
from newslake.session import scratch_path, settle

# Tool -> field -> (type, required). Types: string, integer, number, boolean, array, object.
SCHEMAS: dict[str, dict[str, tuple[str, bool]]] = {
    "search": {"query": ("string", True), "limit": ("integer", True), "after": ("string", False)},
    "lookup": {"key": ("string", True), "exact": ("boolean", False)},
    "calculate": {"left": ("number", True), "right": ("number", True), "operator": ("string", True)},
}
# How the names of parsed JSON types begin; numbers are told apart by value.
_TYPES = {"string": ["STRING"], "integer": ["INTEGER"], "number": ["INTEGER", "NUMBER"], "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"]}
# A number of at most so many digits before or after the point is written out, others with an exponent.
DIGITS = 38
# Strings, numbers and whatever stands between them; possessive, so long strings take no stack.
_TOKENS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.eE+-]*+|[^"0-9-]++'


def _number_parts(number: Column) -> tuple[Column, Column, Column]:
    """Sign, significant digits and power of ten of a JSON number; no digits for zero."""
    fraction = F.regexp_extract(number, r"\.([0-9]+)", 1)
    power = F.coalesce(F.regexp_extract(number, r"[eE]([+-]?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    digits = F.ltrim(F.concat(F.regexp_extract(number, r"^-?([0-9]+)", 1), fraction), F.lit("0"))
    kept = F.rtrim(digits, F.lit("0"))
    sign = F.when(number.startswith("-"), "-").otherwise("")
    return sign, kept, power - F.length(fraction) + F.length(digits) - F.length(kept)


def canonical_number(number: Column) -> Column:
    """The one form of a JSON number: ``100`` for 1e2, 100.0 and 100, ``0.0000001`` for 1e-7, ``15e299`` for 1.5e300.

    What is read as a double has its shortest digits; one too large for a double is the string "Infinity" and no integer.
    """
    sign, digits, power = _number_parts(number)
    padded = F.lpad(digits, F.greatest(F.length(digits), 1 - power), "0")
    whole = F.length(padded) + power
    plain = F.concat(F.substring(padded, F.lit(1), whole), F.lit("."), F.substring(padded, whole + 1, -power))
    form = (F.when((power >= 0) & (F.length(digits) + power <= DIGITS), F.concat(digits, F.repeat(F.lit("0"), power)))
            .when((power < 0) & (power >= -DIGITS), plain).otherwise(F.concat(digits, F.lit("e"), power.cast("string"))))
    return F.when(digits == "", "0").otherwise(F.concat(sign, form))


def _is_whole(number: Column) -> Column:
    _, digits, power = _number_parts(number)
    return number.rlike("^-?[0-9]") & ((digits == "") | (power >= 0))


def _canonical(parsed: Column) -> Column:
    """Text of a parsed value, each number outside strings in its one form."""
    tokens = F.regexp_extract_all(F.to_json(parsed), F.lit(_TOKENS), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.rlike("^-?[0-9]"), canonical_number(t)).otherwise(t)), "")


def _parsed(text: Column) -> Column:
    """The value of a text that is one JSON value and nothing else; null otherwise.

    The parser stops after the first value, so the text is read inside brackets and inside braces: what follows a value may
    go unnoticed in one of them, but only a comma could in both, and then the list has a second element.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"a":'), text, F.lit("}")))
    alone = named.isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.when(alone, F.try_variant_get(listed, "$[0]", "variant"))


def _text(value: Column) -> Column:
    """A JSON string, or null."""
    return F.coalesce(F.regexp_extract(F.to_json(F.array(value)), r"(?s)^\[(.*)\]$", 1), F.lit("null"))


def _is(kind: Column, wanted: str) -> Column:
    out = F.lit(False)
    for prefix in _TYPES[wanted]:
        out = out | kind.startswith(prefix)
    return out


def faults(schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """Sorted array of what is wrong with ``tool`` and the ``fields`` and ``kinds`` of its arguments."""
    is_object = F.col("kinds").isNotNull()
    found = [F.when(F.col("tool").isNull() | ~F.col("tool").isin(*schemas), "unknown tool"), F.when(~is_object, "malformed arguments")]
    for tool, fields in schemas.items():
        here = (F.col("tool") == tool) & is_object
        for field, (kind, required) in fields.items():
            actual = F.col("kinds")[field]
            if required:
                found.append(F.when(here & ~F.array_contains(F.col("fields"), field), f"missing {field}"))
            found.append(F.when(here & F.array_contains(F.col("fields"), field) & ~F.coalesce(_is(actual, kind), F.lit(False)), f"{field} is not {kind}"))
        extra = F.array_except("fields", F.array(*map(F.lit, fields)))
        found.append(F.when(here & (F.size(extra) > 0), F.concat(F.lit("unexpected "), F.array_join(F.array_sort(extra), ","))))
    return F.array_sort(F.array_compact(F.array(*found)))


def _kinds(schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """JSON type of each field that a schema names; null unless the arguments are an object."""
    names = sorted({field for fields in schemas.values() for field in fields})

    def kind(name: str) -> Column:
        value = F.try_variant_get("parsed", f"$.{name}", "variant")
        found = F.schema_of_variant(value)
        number = F.when(_is_whole(F.to_json(value)), "INTEGER").otherwise("NUMBER")
        return F.when(found.rlike("^(BIGINT|DECIMAL|DOUBLE)"), number).otherwise(found)

    found = F.create_map(*(x for n in names for x in (F.lit(n), kind(n))))
    return F.when(F.schema_of_variant("parsed").startswith("OBJECT"), found)


def _chain_ends(single: DataFrame) -> DataFrame:
    """(conv_id, call_id, up, dist, open) of calls with one reference ``up``: where the chain leaves such calls, and after how many steps.

    Each round every pointer takes its target's pointer, so distances double. What is still open once they exceed the number of
    calls is part of, or leads to, a cycle.
    """
    ids = ["conv_id", "call_id"]
    inner = single.select("conv_id", F.col("call_id").alias("up"), F.lit(True).alias("open"))
    pointers = settle(single.join(inner, ["conv_id", "up"], "left").select(*ids, "up", F.lit(1).cast("long").alias("dist"), F.coalesce("open", F.lit(False)).alias("open")), "call-chains")
    reach, calls = 1, pointers.count()
    while reach <= calls and pointers.where("open").take(1):
        target = pointers.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("dist").alias("more"), F.col("open").alias("still"))
        moved = pointers.where("open").join(target, ["conv_id", "up"])
        moved = moved.select(*ids, F.col("next").alias("up"), (F.col("dist") + F.col("more")).alias("dist"), F.col("still").alias("open"))
        pointers = settle(pointers.where("not open").unionByName(moved), "call-chains")
        reach *= 2
    return pointers


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the first calls; level null for those in or behind a cycle."""
    ids = ["conv_id", "call_id"]
    named = calls.select(*ids, F.explode("refers").alias("on")).distinct()
    edges = settle(named.join(calls.select("conv_id", F.col("call_id").alias("on")), ["conv_id", "on"]).select(*ids, "on"), "call-edges")
    counted = settle(edges.groupBy(*ids).agg(F.count("*").alias("waits"), F.min("on").alias("up")), "call-references")
    chains = _chain_ends(counted.where("waits = 1").select(*ids, "up"))
    ends = chains.select("conv_id", F.col("call_id").alias("on"), "up", "dist")
    several = edges.join(counted.where("waits > 1").select(*ids), ids, "left_semi").join(ends, ["conv_id", "on"], "left")
    edges = settle(several.select(*ids, F.coalesce("up", "on").alias("on"), (F.coalesce("dist", F.lit(0)) + 1).alias("steps")), "call-edges")
    spark, folder = calls.sparkSession, scratch_path(calls.sparkSession, "call-levels")
    schema = T.StructType([*calls.select(*ids).schema.fields, T.StructField("level", T.LongType())])

    def write(found: DataFrame, round_: int) -> DataFrame:
        path = f"{folder}/round={round_}"
        found.select(*ids, F.col("level").cast("long").alias("level")).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    waiting = settle(edges.groupBy(*ids).agg(F.count("*").alias("waits"), F.lit(0).cast("long").alias("level")), "call-waits")
    fresh = write(calls.select(*ids, F.lit(0).alias("level")).join(counted, ids, "left_anti"), 0)
    round_ = 0
    while waiting.take(1) and fresh.take(1):
        # Each round reads the calls still waiting, their references and the levels just found, however many rounds came before.
        round_ += 1
        met = edges.join(fresh.select("conv_id", F.col("call_id").alias("on"), F.col("level").alias("base")), ["conv_id", "on"])
        met = met.groupBy(*ids).agg(F.count("*").alias("met"), F.max(F.col("base") + F.col("steps")).alias("least"))
        left = waiting.join(met, ids, "left").select(*ids, (F.col("waits") - F.coalesce("met", F.lit(0))).alias("waits"), F.greatest("level", "least").alias("level"))
        left = settle(left, "call-waits")
        fresh, waiting = write(left.where("waits = 0"), round_), left.where("waits > 0")
        edges = settle(edges.join(waiting.select(*ids), ids, "left_semi"), "call-edges")
    done = spark.read.schema(schema).parquet(folder).select(*ids, "level")
    behind = chains.join(done.select("conv_id", F.col("call_id").alias("up"), "level"), ["conv_id", "up"])
    done = done.unionByName(behind.select(*ids, (F.col("level") + F.col("dist")).alias("level")))
    return calls.select(*ids).join(done, ids, "left").select(*ids, F.col("level").cast("int").alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]] | None = None) -> DataFrame:
    """One row per call, per further result of a call and per result without a call.

    ``calls``: conv_id, turn, call_id, tool, arguments (JSON), refers (array of call ids).
    ``results``: conv_id, turn, call_id, content.
    Returns conv_id, position, call_id, tool, turn, level, status, n_results, faults, canonical.
    Status: ``linked``, ``no result``, ``duplicate``, ``unlinked`` (no id), ``further result`` or ``no call``; rows of results have no level and stand last.
    Of several results in one turn the one whose content has the least hash is the first.
    """
    schemas = schemas or SCHEMAS
    calls = calls.select("conv_id", "turn", "call_id", "tool", "arguments", F.coalesce("refers", F.array().cast("array<string>")).alias("refers"))
    calls = settle(calls.withColumn("row", F.xxhash64("conv_id", "turn", "call_id", "tool", "arguments", F.to_json("refers"))).withColumn("copy", F.monotonically_increasing_id()), "calls")
    sound = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first = calls.where(sound).groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "row", "copy")).alias("first"))
    owned = calls.join(first.select(F.col("first.copy").alias("copy"), F.lit(True).alias("owner")), "copy", "left")
    owned = settle(owned.withColumn("owner", F.coalesce("owner", F.lit(False))).drop("row", "copy"), "owned-calls")
    heads = owned.where("owner")
    results = settle(results.select("conv_id", "turn", "call_id", "content", F.monotonically_increasing_id().alias("copy")), "results")
    per_call = results.where(sound).groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", F.xxhash64("content").alias("row"), "copy")).alias("first"), F.count("*").alias("n_results"))
    per_call = settle(per_call.select(F.col("first.copy").alias("copy"), "n_results"), "first-results")
    answers = results.join(per_call, "copy").select("conv_id", "call_id", F.col("content").alias("result"), "n_results")
    levels = settle(_levels(heads), "levels")
    known = heads.groupBy("conv_id", "call_id").agg(F.lit(True).alias("known"))
    unknown = heads.select("conv_id", F.col("call_id").alias("caller"), F.explode("refers").alias("call_id")).join(
        known, ["conv_id", "call_id"], "left_anti").groupBy("conv_id", F.col("caller").alias("call_id")).agg(F.array_sort(F.collect_set("call_id")).alias("dangling"))
    unknown = settle(unknown, "dangling-references")
    rows = owned.join(answers, ["conv_id", "call_id"], "left").join(levels, ["conv_id", "call_id"], "left").join(unknown, ["conv_id", "call_id"], "left")
    status = (F.when(F.col("conv_id").isNull() | F.col("call_id").isNull(), "unlinked").when(~F.col("owner"), "duplicate")
              .when(F.col("n_results").isNull(), "no result").otherwise("linked"))
    rows = computed_once(rows.withColumns({"parsed": _parsed(F.col("arguments")), "status": status}), "kinds", _kinds(schemas))
    rows = computed_once(rows, "fields", F.coalesce(F.when(F.col("parsed").isNotNull(), F.json_object_keys("arguments")), F.array().cast("array<string>")))
    wrong = F.concat(faults(schemas), F.transform(F.coalesce("dangling", F.array().cast("array<string>")), lambda x: F.concat(F.lit("unknown reference "), x)))
    linked = F.col("status") == "linked"
    canonical = F.concat(
        F.lit('{"arguments":'), F.coalesce(_canonical(F.col("parsed")), _text(F.col("arguments"))), F.lit(',"call_id":'), _text(F.col("call_id")),
        F.lit(',"result":'), F.when(linked, _text(F.col("result"))).otherwise(F.lit("null")), F.lit(',"tool":'), _text(F.col("tool")), F.lit("}"))
    made = rows.select("conv_id", "turn", "call_id", "tool", F.when(F.col("owner"), F.col("level")).alias("level"), "status",
                       F.when(F.col("owner"), F.coalesce("n_results", F.lit(0))).otherwise(0).cast("long").alias("n_results"), wrong.alias("faults"), canonical.alias("canonical"))
    rest = results.join(per_call.select("copy"), "copy", "left_anti").join(known, ["conv_id", "call_id"], "left_semi")
    lost = results.join(known, ["conv_id", "call_id"], "left_anti")

    def unlinked(found: DataFrame, why: str) -> DataFrame:
        text = F.concat(F.lit('{"call_id":'), _text(F.col("call_id")), F.lit(',"result":'), _text(F.col("content")), F.lit("}"))
        return found.select("conv_id", "turn", "call_id", F.lit(None).cast("string").alias("tool"), F.lit(None).cast("int").alias("level"), F.lit(why).alias("status"),
                            F.lit(0).cast("long").alias("n_results"), F.array(F.lit(why)).alias("faults"), text.alias("canonical"))

    both = made.unionByName(unlinked(rest, "further result")).unionByName(unlinked(lost, "no call")).withColumns({"last": F.coalesce("level", F.lit(2**31 - 1)), "tie": F.xxhash64("status", "canonical")})
    order = ["last", "turn", "call_id", "tie", "canonical"]
    return numbered(both, ["conv_id"], order).select("conv_id", "position", "call_id", "tool", "turn", "level", "status", "n_results", "faults", "canonical")


def logged_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as a tool log would hold them, derived from every turn of the conversations.

    Each user turn is a call whose arguments quote the whole turn. Each assistant turn is a result, of the call in the
    turn before it if that is a user's. Turns of all other roles, or of none, are results without a call id. By the turn's
    number and text, some calls refer to the call before and some lack or mistype an argument.
    """
    tool = F.element_at(F.array(*map(F.lit, sorted(SCHEMAS))), (F.pmod(F.xxhash64("text"), F.lit(3)) + 1).cast("int"))
    fault = F.pmod(F.xxhash64("text", F.lit("fault")), F.lit(10))
    number = F.length("text").cast("string")
    body = (
        F.when(tool == "search", F.concat(F.lit('{"query": '), _text(F.col("text")), F.when(fault == 0, "").otherwise(F.concat(F.lit(', "limit": '), F.when(fault == 1, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number))), F.lit("}")))
        .when(tool == "lookup", F.concat(F.lit('{"key":'), _text(F.col("text")), F.when(fault == 2, ', "fuzzy":true').otherwise(', "exact" :false'), F.lit("}")))
        .otherwise(F.concat(F.lit('{"right":'), number, F.lit(', "operator":"+", "left":'), F.col("turn").cast("string"), F.when(fault == 3, "").otherwise("}")))
    )
    name = lambda turn: F.concat(F.lit("call_"), turn.cast("string"))
    asked = turns.where("role = 'user'")
    refers = F.when((F.col("turn") > 2) & (fault < 6), F.array(name(F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    calls = asked.select("conv_id", "turn", name(F.col("turn")).alias("call_id"), tool.alias("tool"), body.alias("arguments"), refers.alias("refers"))
    others = turns.where(~F.col("role").eqNullSafe("user"))
    answers = F.when(F.col("role") == "assistant", name(F.col("turn") - 1))
    results = others.select("conv_id", "turn", answers.alias("call_id"), F.col("text").alias("content"))
    return calls, results
