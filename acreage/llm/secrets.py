"""Secret scanning with links between the parts of one credential, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
#: Weak parts: they are reported only beside a complementary part.
IDENT = r"""(?i:client_?id|access_?key_?id|account_?id|user_?name)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]+)"""
LOOSE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{32,}"
ENDPOINT = r"(?i:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[^\s\"'<>]+"
#: Matches whose places are summed up at once.
CHUNK = 128
#: Kinds in the order in which spans with the same start are listed.
KINDS = ["assign", "access", "hex", "ident", "loose", "endpoint"]


def matches(text: Column, pattern: str, kind: str, least: int = 0, group: int = 0) -> Column:
    """The leftmost non-overlapping matches as structs (start, rank, end, kind), in code points, whose group has least characters.

    Places are summed up in chunks of CHUNK matches, so that a text with very many isn't copied for each of them.
    """
    rank = KINDS.index(kind)
    whole, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    steps = F.arrays_zip(
        F.transform(F.slice(between, 1, F.size(whole)), F.length).alias("skip"), F.transform(whole, F.length).alias("width"),
        F.transform(part, F.length).alias("held")
    )
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,held:int>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["skip"]
        end = start + x["width"]
        return F.struct(
            end.alias("at"),
            F.concat(
                acc["got"],
                F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), x["held"].alias("held")))
            ).alias("got")
        )

    def place(acc: Column, x: Column) -> Column:
        return F.struct(
            (acc["at"] + F.aggregate(x, F.lit(0), lambda n, y: n + y["skip"] + y["width"])).alias("at"),
            F.concat(acc["got"], F.array(acc["at"])).alias("got")
        )

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / CHUNK).cast("int")), lambda k: F.slice(steps, k * CHUNK + 1, CHUNK)
    )
    begins = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("got")), place)["got"]
    found = F.flatten(
        F.zip_with(chunks, begins, lambda x, at: F.aggregate(x, F.struct(at.alias("at"), empty.alias("got")), add)["got"])
    )
    found = F.filter(found, lambda s: s["held"] >= least) if least else found
    return F.when(text.rlike(pattern), found).otherwise(empty)


def listed(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ","
    )


def near(a: Column, others: Column, scope: int) -> Column:
    """Whether an interval of others lies at most scope code points from interval a."""
    return F.exists(others, lambda b: (b["start"] - a["end"] <= scope) & (a["start"] - b["end"] <= scope))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, scope: int = 400) -> DataFrame:
    """One row for each row of docs: (id, n_assign, n_access, n_hex, base, spans, n_linked).

    base lists the matches of the three base patterns; spans adds weak candidates that have their complement within
    scope code points: an account identifier beside a secret, a loose mixed-case random string beside an access
    identifier, an endpoint beside both. The interval join runs inside each row over the parts found there, so nothing
    is shuffled and a hot source costs no more than its own text. A loose string that a base span covers is not listed
    again. Null texts count as empty; repeated rows give repeated results; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(
        F.col(id_col).alias(id_col),
        matches(text, ASSIGN, "assign", 8, 1).alias("_assign"),
        matches(text, ACCESS, "access", 16).alias("_access"),
        matches(text, HEX, "hex", 32).alias("_hex"),
        matches(text, IDENT, "ident", 4, 1).alias("_ident"),
        matches(text, LOOSE, "loose", 32).alias("_loose"),
        matches(text, ENDPOINT, "endpoint").alias("_endpoint"),
    )
    base = F.concat("_assign", "_access", "_hex")
    loose = F.filter("_loose", lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    found = found.withColumn("_loose", loose)
    access, secret = F.concat("_access", "_ident"), F.concat("_assign", "_hex", "_loose")
    linked = F.concat(
        F.filter("_ident", lambda s: near(s, secret, scope)),
        F.filter("_loose", lambda s: near(s, access, scope)),
        F.filter("_endpoint", lambda s: near(s, access, scope) & near(s, secret, scope)),
    )
    return found.select(
        id_col,
        F.size("_assign").cast("long").alias("n_assign"), F.size("_access").cast("long").alias("n_access"), F.size("_hex").cast("long").alias("n_hex"),
        listed(base).alias("base"), listed(F.concat(base, linked)).alias("spans"), F.size(linked).cast("long").alias("n_linked"),
    )
