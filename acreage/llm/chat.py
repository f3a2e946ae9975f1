"""Chat formatting: tool calls joined to their results, ordered, validated and written as canonical JSON. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.components import components
from acreage.llm.scratch import stage

#: What a message with calls looks like: {"tool_calls": [{"id", "name", "arguments", "after"}]}; a result has {"tool_call_id", "content"}.
CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:string,after:array<string>>>,tool_call_id:string,content:string>"
#: The types of a schema, by what schema_of_variant calls values of theirs.
KINDS = {
    "string": r"STRING", "integer": r"BIGINT|DECIMAL\(\d+,0\)", "number": r"BIGINT|DECIMAL\(.*|DOUBLE|FLOAT",
    "boolean": r"BOOLEAN", "object": r"OBJECT<.*", "array": r"ARRAY<.*"
}
#: Calls that hang together in groups of at most so many are put in order row by row, larger groups in rounds over tables.
TOGETHER = 1000
#: Settled calls of so many rounds are written as one table, so that plans stay short.
MERGED = 16


def quoted(text: Column) -> Column:
    """A JSON string. Control characters below U+0020 are escaped as JSON wants it; all else stays as it is."""
    return F.regexp_extract(
        F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("a")), {"ignoreNullFields": "false"}), r"(?s)^\{\"a\":(.*)\}$", 1
    )


def canonical(fields: Mapping[str, Column]) -> Column:
    """An object with its keys in code point order and no blanks; the columns are JSON already."""
    parts = [F.concat(F.lit(f'"{k}":'), fields[k]) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def parsed(text: Column) -> Column:
    """The only JSON value of a text as a variant; null where there is none, more, or something after it.

    Null are also objects that repeat a key, values larger than a variant, and numbers beyond a double.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    endless = F.regexp_count(F.to_json(named), F.lit('Infinity"')) > F.regexp_count(text, F.lit('Infinity"'))
    alone = F.try_variant_get(
        listed, "$[0]", "variant"
    ).isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull() & ~endless
    return F.when(alone, F.try_variant_get(named, "$.v", "variant"))


def written(value: Column) -> Column:
    """A variant as JSON without blanks, the keys of all objects in it sorted (by UTF-16 units), equal numbers alike.

    Whole numbers and decimals of at most 38 digits are exact and lose zeros at the end; others, and all with an
    exponent, are doubles in their shortest form.
    """
    text = F.to_json(value)
    # Outside of strings: no quote is within one once \\\\ and \\" are replaced by signs that JSON text never holds.
    parts = F.split(F.replace(F.replace(text, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02")), '"', -1)
    short = F.transform(parts, lambda x, i: F.when(i % 2 == 0, F.regexp_replace(x, r"\.0(?=[E,\]}]|$)", "")).otherwise(x))
    joined = F.replace(F.replace(F.array_join(short, '"'), F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
    return F.when(text.rlike(r"\d\.0(?:[E,\]}]|$)"), joined).otherwise(text)


def canonical_arguments(arguments: Column) -> Column:
    """Arguments as canonical JSON (see written); null where they are not one JSON object (see parsed)."""
    value = parsed(arguments)
    return F.when(kind_of(value).startswith("OBJECT<"), written(value))


def kind_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def faults_in(value: Column, fields: Mapping[str, Mapping], at: str = "") -> Column:
    """What speaks against an object, a variant, under {name: {type, required, min_length, properties, items}}: a list.

    properties are the fields of an object, items is what each element of an array must be. A null counts as missing.
    """
    checks = []
    for name, want in sorted(fields.items()):
        if want["type"] not in KINDS or {"'", "\\"} & set(name):
            raise ValueError(f"no such schema: {name}: {want['type']}")
        own = F.try_variant_get(value, f"$['{name}']", "variant")
        there = own.isNotNull() & ~F.coalesce(F.is_variant_null(own), F.lit(False))
        if want.get("required"):
            checks.append(F.array(F.when(~there, F.lit(f"{at}{name} is missing"))))
        checks.append(F.when(there, faults_of_value(own, want, f"{at}{name}")))
    known = F.array(*[F.lit(k) for k in sorted(fields)]).cast("array<string>")
    keys = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
    checks.append(
        F.array(F.when(F.size(F.array_except(keys, known)) > 0, F.lit(f"unknown argument{' of ' + at[:-1] if at else ''}")))
    )
    none = F.array().cast("array<string>")
    return F.filter(F.flatten(F.array(*[F.coalesce(c, none) for c in checks])), lambda x: x.isNotNull())


def faults_of_value(value: Column, want: Mapping, name: str) -> Column:
    fits = kind_of(value).rlike(f"^(?:{KINDS[want['type']]})$")
    out = [F.array(F.when(~fits, F.lit(f"{name} is no {want['type']}")))]
    if "min_length" in want:
        out.append(
            F.array(
                F.when(
                    fits & (F.length(F.try_variant_get(value, "$", "string")) < want["min_length"]),
                    F.lit(f"{name} is too short")
                )
            )
        )
    if "properties" in want:
        out.append(F.when(fits, faults_in(value, want["properties"], f"{name}.")))
    if "items" in want:
        items = F.try_variant_get(value, "$", "array<variant>")
        out.append(
            F.array(
                F.when(
                    F.exists(
                        items, lambda x: F.size(F.filter(faults_of_value(x, want["items"], ""), lambda f: f.isNotNull())) > 0
                    ),
                    F.lit(f"{name} has an unfit item")
                )
            )
        )
    none = F.array().cast("array<string>")
    return F.flatten(F.array(*[F.coalesce(x, none) for x in out]))


def faults_of(arguments: Column, schema: Mapping[str, Mapping]) -> Column:
    """What speaks against arguments as parsed by parsed, under the schema of faults_in; a list, empty if nothing."""
    is_object = F.coalesce(kind_of(arguments).startswith("OBJECT<"), F.lit(False))
    return F.when(is_object, faults_in(arguments, schema)).otherwise(F.array(F.lit("not an object")))


def depths(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv, node, depth): the longest way of edges (conv, src, dst) to a node; null where a cycle holds it back.

    Calls that hang together over edges are one group. A group of at most TOGETHER calls is one row, in which every
    round gives each call one more than the greatest depth before it; as many rounds as calls settle all that no cycle
    holds back. Larger groups, of any size, are settled in rounds over tables.
    """
    key = lambda c: F.xxhash64("conv", c)  # noqa: E731  two groups with the same hash are one row, with the same result
    held = edges.join(
        nodes.select("conv", F.col("node").alias("src")), ["conv", "src"], "left_semi"
    ).join(nodes.select("conv", F.col("node").alias("dst")), ["conv", "dst"], "left_semi").distinct()
    held = stage(held.withColumns({"a": key("src"), "b": key("dst")}), "order")
    depth = nodes.select("conv", "node").distinct().withColumn("depth", F.lit(0))
    if held.isEmpty():
        return depth
    groups = components(held.select("a", "b"))
    sizes = groups.groupBy("root").agg(F.count("*").alias("n"))
    placed = held.join(groups.select(F.col("node").alias("a"), "root"), "a", "left").join(sizes, "root", "left")
    # A call that only waits for itself is a group of its own.
    placed = stage(
        placed.select("conv", "src", "dst", F.coalesce("root", "a").alias("root"), F.coalesce("n", F.lit(1)).alias("n")),
        "groups"
    )
    settled = ordered_rows(placed.where(F.col("n") <= TOGETHER)).unionByName(
        ordered_rounds(placed.where(F.col("n") > TOGETHER).select("conv", "src", "dst"))
    )
    return depth.join(
        settled.withColumnRenamed("depth", "own").withColumn("found", F.lit(True)), ["conv", "node"], "left"
    ).select("conv", "node", F.when(F.col("found"), F.col("own")).otherwise(F.col("depth")).alias("depth"))


def ordered_rows(edges: DataFrame) -> DataFrame:
    """(conv, node, depth) of the nodes of edges (root, conv, src, dst): each root's whole group in one row."""
    ends = edges.select("root", F.struct("conv", F.col("src").alias("node")).alias("x")).union(
        edges.select("root", F.struct("conv", F.col("dst").alias("node")).alias("x"))
    )
    named = ends.groupBy("root").agg(F.array_sort(F.collect_set("x")).alias("nodes"))
    before = edges.groupBy("root", "conv", "dst").agg(F.collect_set("src").alias("srcs")).groupBy("root").agg(
        F.collect_list(F.struct(F.struct("conv", F.col("dst").alias("node")).alias("x"), "srcs")).alias("before")
    )
    both = named.join(before, "root")
    place = lambda x: F.array_position("nodes", x) - 1
    held = F.map_from_entries(
        F.transform(
            "before",
            lambda e: F.struct(
                place(e["x"]).alias("at"),
                F.transform(e["srcs"], lambda s: place(F.struct(e["x"]["conv"].alias("conv"), s.alias("node")))).alias("of")
            )
        )
    )
    both = both.select(
        "nodes",
        F.transform(
            F.sequence(F.lit(0), F.size("nodes") - 1), lambda k: F.coalesce(held[k.cast("long")], F.array().cast("array<long>"))
        ).alias("of")
    )
    step = lambda d, _: F.transform(
        "of", lambda ps: F.coalesce(F.array_max(F.transform(ps, lambda p: F.get(d, p.cast("int")) + 1)), F.lit(0))
    )
    rounds = F.aggregate(F.sequence(F.lit(1), F.size("nodes")), F.array_repeat(F.lit(0), F.size("nodes")), step)
    out = both.select(F.size("nodes").alias("n"), F.explode(F.arrays_zip(F.col("nodes"), rounds.alias("depth"))).alias("z"))
    return out.select("z.nodes.conv", "z.nodes.node", F.when(F.col("z.depth") < F.col("n"), F.col("z.depth")).alias("depth"))


def ordered_rounds(edges: DataFrame) -> DataFrame:
    """The same for edges (conv, src, dst) of groups of any size: each round settles what only settled calls come before.

    There are as many rounds as the longest chain has links; what a round can't shorten waits for a cycle.
    """
    left = stage(edges, "order")
    size = left.count()
    ends = left.select("conv", F.col("src").alias("node")).union(left.select("conv", F.col("dst").alias("node"))).distinct()
    settled = ends.join(
        left.select("conv", F.col("dst").alias("node")), ["conv", "node"], "left_anti"
    ).withColumn("depth", F.lit(0))
    for k in count(1):
        if not size:
            return settled
        waiting = left.select("conv", F.col("dst").alias("node")).distinct()
        later = stage(left.join(waiting.select("conv", F.col("node").alias("src")), ["conv", "src"], "left_semi"), "order")
        after = later.count()
        if after == size:
            return settled.unionByName(waiting.withColumn("depth", F.lit(None).cast("int")))
        done = waiting.join(
            later.select("conv", F.col("dst").alias("node")), ["conv", "node"], "left_anti"
        ).withColumn("depth", F.lit(k))
        settled = settled.unionByName(stage(done, "depth"))
        if k % MERGED == 0:
            settled = stage(settled, "depth")
        left, size = later, after


def parsed_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls (conv, turn, pos, id, name, arguments, after) and results (conv, turn, id, content) written as JSON in messages."""
    got = messages.where(F.col("text").rlike(r"^\s*\{")).withColumn("j", F.from_json("text", CALLS))
    calls = got.select(
        "conv", "turn", F.posexplode("j.tool_calls")
    ).select("conv", "turn", "pos", "col.*").where("id is not null")
    return calls, got.where("j.tool_call_id is not null").select(
        "conv", "turn", F.col("j.tool_call_id").alias("id"), F.col("j.content").alias("content")
    )


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """One row for each call, and for each result without one: (conv, id, name, turn, depth, status, faults, json).

    Calls (conv, turn, pos, id, name, arguments, after) are hash-joined to results (conv, turn, id, content) on
    conversation and identifier. after lists the calls that must come before; depth is the place in the topological
    order, null inside or behind a cycle. Status is one of ok, invalid (the arguments break the schema of the name, or
    there is none), unanswered, orphan (a result without a call), ambiguous (more than one call or result has the
    identifier; of these the first by turn, place in the message and then values is shown, and all their links count) and
    cyclic. Arguments are judged for each by faults_in; json is canonical: sorted keys, no blanks, equal numbers alike, at
    all levels of the arguments; arguments that are no JSON object are a string. Null identifiers and conversations
    are left out. A hot conversation is only as many rows: joins are on conversation and identifier together.
    """
    calls = calls.where("id is not null and conv is not null")
    one = calls.groupBy("conv", "id").agg(
        F.min(F.struct("turn", "pos", "name", "arguments", "after")).alias("c"), F.count("*").alias("n_calls")
    )
    answers = results.where("id is not null and conv is not null").groupBy("conv", "id").agg(
        F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results")
    )
    edges = calls.select("conv", F.explode("after").alias("src"), F.col("id").alias("dst")).where("src is not null")
    order = depths(one.select("conv", F.col("id").alias("node")), edges).withColumnRenamed("node", "id")
    both = one.join(answers, ["conv", "id"], "full").join(order, ["conv", "id"], "left").withColumn(
        "value", parsed(F.col("c.arguments"))
    )
    faults = F.array(F.lit("no schema"))
    for name, schema in schemas.items():
        faults = F.when(F.col("c.name") == name, faults_of(F.col("value"), schema)).otherwise(faults)
    faults = F.when(F.col("c").isNull(), F.array().cast("array<string>")).otherwise(faults)
    status = (
        F.when(F.col("c").isNull(), "orphan").when(
            (F.col("n_calls") > 1) | (F.col("n_results") > 1), "ambiguous"
        ).when(F.col("depth").isNull(), "cyclic")
        .when(F.size(faults) > 0, "invalid").when(F.col("r").isNull(), "unanswered").otherwise("ok")
    )
    fields = {
        "arguments": F.when(
            kind_of(F.col("value")).startswith("OBJECT<"), written(F.col("value"))
        ).otherwise(quoted(F.col("c.arguments"))), "call_id": quoted(F.col("id")), "name": quoted(F.col("c.name")),
        "result": F.when(F.col("r").isNull(), "null").otherwise(quoted(F.col("r.content"))), "status": quoted(status),
    }
    return both.select(
        "conv", "id", F.col("c.name").alias("name"), F.coalesce("c.turn", "r.turn").alias("turn"), "depth",
        status.alias("status"), faults.alias("faults"), canonical(fields).alias("json")
    )


def turns_as_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain dialogue read as calls: a user turn asks the tool reply, and the assistant's turn after it is the result.

    The identifier is the number of the asking turn. Such calls have none that must come before them.
    """
    users = messages.where("role = 'user' and turn is not null")
    calls = users.select(
        "conv", "turn", F.lit(-1).alias("pos"), F.concat(
            F.lit("t"), F.col("turn").cast("string")
        ).alias("id"), F.lit("reply").alias("name"),
        canonical({"query": quoted(F.col("text"))}).alias("arguments"), F.array().cast("array<string>").alias("after"),
    )
    answers = messages.where("role = 'assistant' and turn is not null")
    return calls, answers.select(
        "conv", "turn", F.concat(F.lit("t"), (F.col("turn") - 1).cast("string")).alias("id"),
        F.coalesce("text", F.lit("")).alias("content")
    )


def format_chats(
    conversations: DataFrame, schemas: Mapping[str, Mapping], conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """Rows of link_calls over the calls that messages hold as JSON and over the question and answer turns of all others.

    A message without any identifier of a call, such as one with an empty tool_calls list, counts among all others. Left
    out are turns of all others that aren't a user's or the assistant's (system turns), those without a turn number, calls
    without an identifier beside others that have one, and rows without a conversation.
    """
    messages = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
        F.col(text_col).alias("text")
    )
    calls, results = parsed_calls(messages)
    held = F.when(F.col("text").rlike(r"^\s*\{"), F.from_json("text", CALLS))
    linked = F.exists(held["tool_calls"], lambda c: c["id"].isNotNull()) | held["tool_call_id"].isNotNull()
    plain = messages.where(~F.coalesce(linked, F.lit(False)))
    more, answers = turns_as_calls(plain)
    return link_calls(calls.unionByName(more), results.unionByName(answers), schemas)
