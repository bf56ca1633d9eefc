"""Secret scan with multipart credential linking.

Certain findings (base spans) are reported alone. Weak candidates - an account name, a random-looking
token, an address - say little alone: they are reported only where complementary parts stand in reach of
them in the same scope, found by an interval join in Spark over buckets of positions.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, member_bits, parted, same, stored, strings, text_hash, unused

#: The certain patterns, each with the least length of what it must hold.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

#: Weak candidates by role.
IDENTIFIER = re.compile(r"""(?ai)(?:user(?:_?name|_?id)?|login|account|client_?id|access_?key(?:_?id)?|key_?id|app_?id)"""
                        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})""")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
ENDPOINT = re.compile(r"""(?ai)https?://[^\s"'<>]+|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?::\d{2,5})?(?![\d.])|"""
                      r"""(?:host(?:name)?|server|endpoint|base_?url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:/_-]{4,}""")
#: Order of kinds at one start, and the part of a credential each is.
KINDS = {"assign": "secret", "access": "identifier", "hex": "secret", "account": "identifier", "opaque": "secret",
         "address": "endpoint"}
BASE = ("assign", "access", "hex")
#: What must be in reach of a weak candidate: all parts of its list.
NEEDS = {"account": ["secret"], "opaque": ["identifier"], "address": ["identifier", "secret"]}
#: Farthest gap between parts, in code points; blank lines end a scope.
REACH = 200
_BLANK = re.compile(r"\n[ \t\r]*\n")


def _opaque(s: str) -> bool:
    """Random-looking: letters and digits, and three bits of entropy a character."""
    if not (any(c.isdigit() for c in s) and any(c.isalpha() for c in s)):
        return False
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) >= 3.0


def scan(text: str) -> list[tuple[str, int, int, int]]:
    """``(kind, scope, start, end)`` of the certain and the weak parts of one text, in code points."""
    out = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    weak = [("account", *m.span()) for m in IDENTIFIER.finditer(text)] if ":" in text or "=" in text else []
    if weak or any(k == "access" for k, _, _ in out):  # nothing weak is ever reported without an identifier
        taken = sorted((s, e) for _, s, e in [*out, *weak])
        weak += [("address", *m.span()) for m in ENDPOINT.finditer(text)]
        taken += [(s, e) for k, s, e in weak if k == "address"]
        taken.sort()
        at = 0
        for m in TOKEN.finditer(text):
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if (at == len(taken) or taken[at][0] >= m.end()) and _opaque(m[0]):
                weak.append(("opaque", *m.span()))
        out += weak
    if not out:
        return []
    ends = [m.end() for m in _BLANK.finditer(text)]
    found, scope = [], 0
    for kind, s, e in sorted(out, key=lambda x: x[1]):
        while scope < len(ends) and ends[scope] <= s:
            scope += 1
        found.append((kind, scope, s, e))
    return found


def parts(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, parts)`` for each row of ``docs(doc_id, text)``."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("scope", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[dict(zip(("kind", "scope", "start", "end"), x, strict=True)) for x in scan(t)] for t in strings(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, kind)], ["doc_id", "text_hash", "parts"])

    return (docs.select(F.col("doc_id").cast("long"), text_hash().alias("text_hash"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, text_hash long, parts array<struct<kind:string,scope:int,start:bigint,end:bigint>>"))


def _lookup(values: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def linked(found: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak parts of ``found`` (rows of :func:`parts`) whose complements are in reach: an interval join
    on (document, scope, bucket of positions). Copies of a document are joined once. A bucket holds no more
    parts than fit in ``reach`` code points, so no group grows with the data."""
    one = found.filter(F.exists("parts", lambda p: ~p["kind"].isin(*BASE))).dropDuplicates(["doc_id", "text_hash"])
    every = one.select("doc_id", "text_hash", F.inline("parts"))
    bucket = lambda s, e: F.explode(F.sequence(F.floor(s / reach), F.floor(e / reach)))
    weak = every.filter(~F.col("kind").isin(*BASE)).select(
        "*", bucket(F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach).alias("bucket"))
    other = every.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("scope").alias("sc"),
                         F.col("start").alias("s"), F.col("end").alias("e"), _lookup(KINDS, F.col("kind")).alias("part"),
                         bucket(F.col("start"), F.col("end")).alias("b"))
    near = ((weak["start"] - other["e"] <= reach) & (other["s"] - weak["end"] <= reach)
            & ~((weak["start"] == other["s"]) & (weak["end"] == other["e"])))
    met = weak.join(other, same(weak, other, [("doc_id", "d"), ("text_hash", "h"), ("scope", "sc"), ("bucket", "b")]) & near)
    have = met.groupBy("doc_id", "text_hash", "kind", "start", "end").agg(
        *[F.max(F.when(F.col("part") == p, True).otherwise(False)).alias(p) for p in ("identifier", "secret", "endpoint")])
    enough = F.lit(False)
    for kind, needs in NEEDS.items():
        ok = F.col("kind") == kind
        for p in needs:
            ok = ok & F.col(p)
        enough = enough | ok
    return have.filter(enough).select("doc_id", "text_hash", "kind", "start", "end")


def _sorted(spans: Column) -> Column:
    order = {k: i for i, k in enumerate(KINDS)}
    keyed = F.transform(spans, lambda p: F.struct(p["start"].alias("start"), _lookup(order, p["kind"]).alias("rank"),
                                                  p["end"].alias("end"), p["kind"].alias("kind")))
    return F.transform(F.sort_array(keyed), lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))


def secrets(spark: SparkSession, docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``(doc_id, text_hash, spans)`` for each row of ``docs(doc_id, text)``; spans are ``(kind, start,
    end)`` in code points, end exclusive, by start and then kind.

    Null and empty texts have no spans; repeated rows each get theirs; a null ``doc_id`` is an id like any
    other; an empty table gives no rows; other columns are not read."""
    bounded_batches(spark)
    found = stored(spark, parts(docs), "secret-parts")
    more = (linked(found, reach).groupBy("doc_id", "text_hash")
            .agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
            .select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "more"))
    base = F.transform(F.filter("parts", lambda p: p["kind"].isin(*BASE)),
                       lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    out = found.select("doc_id", "text_hash", base.alias("base")).join(
        more, found["doc_id"].eqNullSafe(more["d"]) & (found["text_hash"] == more["h"]), "left")
    return out.select("doc_id", "text_hash", _sorted(F.when(F.col("more").isNull(), F.col("base"))
                                                     .otherwise(F.concat("base", "more"))).alias("spans"))


def mask(spark: SparkSession, docs: DataFrame, reach: int = REACH, by: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced; overlapping spans become one. Rows and
    columns stay as they are, but ``n_chars``, where there is one, counts the new text of changed rows."""
    own = unused(docs, "_s_spans")
    found = (secrets(spark, docs, reach).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "text_hash"])
             .select(F.col("doc_id").alias("_s_id"), F.col("text_hash").alias("_s_hash"), F.col("spans").alias(own)))
    found = stored(spark, found, "secret-spans")
    bits = member_bits(spark, found.select(F.xxhash64("_s_id", "_s_hash").alias("ref")))
    may, rest = parted(docs, F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))), bits)
    out = may.join(found, may["doc_id"].cast("long").eqNullSafe(found["_s_id"])
                   & (F.xxhash64(may["text"].cast("string")) == found["_s_hash"]), "left").select(*[may[f"`{c}`"] for c in docs.columns], found[own])
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("text"))
    step = lambda a, p: F.when(  # noqa: E731  a span that begins inside the last one only lengthens it
        p["start"] >= a["at"], F.struct(F.greatest(a["at"], p["end"]).alias("at"), F.concat(
            a["text"], F.col("text").substr((a["at"] + 1).cast("int"), (p["start"] - a["at"]).cast("int")), F.lit(by)).alias("text"))
    ).otherwise(F.struct(F.greatest(a["at"], p["end"]).alias("at"), a["text"].alias("text")))
    new = F.aggregate(own, start, step, lambda a: F.concat(a["text"], F.col("text").substr((a["at"] + 1).cast("int"), F.length("text"))))
    out = out.withColumn("text", F.when(F.col(own).isNull(), F.col("text")).otherwise(new))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(own).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))
    return out.select(*[f"`{c}`" for c in docs.columns]).unionByName(rest)
