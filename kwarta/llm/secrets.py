"""Secrets in texts with multipart credential linking: only DataFrame functions.

Strong findings are reported wherever they stand. Weak candidates, a bare key, an endpoint or an account, say little
alone: they are reported only where the complementary part of a credential stands in the same scope, which an interval
join over scope-wide bins finds. Only texts that hold both kinds take part in the join, and of repeated texts
one; a bin holds as many parts as fit into its characters, so no group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kwarta.llm.shared import written

#: Characters between the parts of one credential at most.
SCOPE = 200

#: What is looked for. Per kind a pattern, the group that is measured, its least and most characters.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, None),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, None),
    "hex": (r"[0-9a-f]+", 0, 24, None),
    "bare": (r"[A-Za-z0-9+/=]+", 0, 40, 40),
    "endpoint": (r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?", 0, 12, None),
    "account": (r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+[.][A-Za-z]+", 0, 6, None),
}
BASE, WEAK = ("assign", "access", "hex"), ("bare", "endpoint", "account")
#: The parts that a weak candidate needs in its scope.
COMPLEMENT = {"bare": ("access",), "endpoint": ("assign", "access", "hex"), "account": ("assign", "hex")}
#: Runs of one class are looked for at their least length at once; the match is the same whole run.
_RUNS = {"access": r"AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}", "bare": "[A-Za-z0-9+/=]{40,}"}

_SPAN, _AT_ONCE = "array<struct<start:int,end:int>>", 256


def _running(lengths: Column) -> Column:
    """The sum before each element, in slices, so that long arrays are not copied for each element."""
    def plain(array: Column) -> Column:
        start = F.struct(F.array().cast("array<int>").alias("sums"), F.lit(0).alias("total"))
        return F.aggregate(
            array, start,
            lambda a, x: F.struct(F.concat(a["sums"], F.array(a["total"])).alias("sums"), (a["total"] + x).alias("total")),
            lambda a: a["sums"])

    slices = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _AT_ONCE).cast("int")),
        lambda i: F.slice(lengths, i * _AT_ONCE + 1, F.lit(_AT_ONCE)))
    before = plain(F.transform(slices, lambda s: F.aggregate(s, F.lit(0), lambda a, x: a + x)))
    return F.flatten(F.zip_with(slices, before, lambda s, b: F.transform(plain(s), lambda x: x + b)))


def spans(text: Column, kind: str) -> Column:
    """Where a kind's leftmost non-overlapping matches stand, in code points; matches that fail its lengths are dropped."""
    pattern, group, least, most = KINDS[kind]
    pattern = F.lit(_RUNS.get(kind, pattern))
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.transform(matches, F.length)
    measured = whole if group == 0 else F.transform(F.regexp_extract_all(text, pattern, F.lit(group)), F.length)
    lengths = F.zip_with(whole, F.slice(between, 1, F.size(whole)), lambda m, b: m + b)
    ends = F.zip_with(_running(lengths), lengths, lambda r, n: r + n)
    found = F.transform(
        F.arrays_zip(ends.alias("e"), whole.alias("w"), measured.alias("m")),
        lambda x: F.struct((x["e"] - x["w"]).alias("start"), x["e"].alias("end"), x["m"].alias("size")))
    fits = F.filter(found, lambda x: (x["size"] >= least) & (x["size"] <= (most or 2**31 - 1)))
    listed = F.transform(fits, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return F.when(F.regexp_like(text, pattern), listed).otherwise(F.array().cast(_SPAN))


def _named(kind: str, order: int) -> Column:
    return F.transform(kind, lambda x: F.struct(
        x["start"].alias("start"), F.lit(order).alias("order"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def _joined(parts: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    return F.array_join(F.transform(F.array_sort(parts), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(key, found): per text the weak candidates with a complementary part at most `scope` characters away."""
    each = parts.select("key", F.explode(F.concat(*(_named(k, i) for i, k in enumerate(KINDS)))).alias("p")).select("key", "p.*")
    width = F.lit(float(scope))
    weak = each.where(F.col("kind").isin(*WEAK)).withColumn(
        "bin", F.explode(F.sequence(F.floor((F.col("start") - scope) / width), F.floor((F.col("end") + scope) / width))))
    strong = each.where(F.col("kind").isin(*BASE)).select(
        F.col("key").alias("k"), F.col("kind").alias("part"), F.col("start").alias("s"), F.col("end").alias("e"),
        F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))).alias("b"))
    needs = F.lit(False)
    for kind, wanted in COMPLEMENT.items():
        needs = needs | ((F.col("kind") == kind) & F.col("part").isin(*wanted))
    near = (F.col("s") <= F.col("end") + scope) & (F.col("start") <= F.col("e") + scope)
    same = (F.col("key") == F.col("k")) & (F.col("bin") == F.col("b"))
    hits = weak.join(strong, same & near & needs, "left_semi").drop("bin").distinct()
    return hits.groupBy("key").agg(F.collect_list(F.struct("start", "order", "end", "kind")).alias("found"))


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, scope: int = SCOPE) -> DataFrame:
    """One row per row: doc_id, counts n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    Positions are code points of the whole text, ends exclusive. A null or empty text has no spans (an empty
    list and its digest). Repeated rows give repeated results, null ids stay null. Empty table: no rows. A weak
    candidate that overlaps a strong finding is not one.
    """
    whole = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    rows = docs.select(docs[f"`{doc_id}`"].alias("id"), whole.alias("text"))
    strong = rows.select("id", "text", *(spans(F.col("text"), k).alias(k) for k in BASE))
    some = F.size("assign") + F.size("access") + F.size("hex") > 0
    none = F.array().cast(_SPAN)
    weak = strong.select(
        "id", *BASE, F.when(some, F.sha2(F.col("text").cast("binary"), 256)).alias("key"),
        F.when(F.size("access") > 0, spans(F.col("text"), "bare")).otherwise(none).alias("bare"),
        *(F.when(some, spans(F.col("text"), k)).otherwise(none).alias(k) for k in ("endpoint", "account")))
    apart = lambda w: ~F.exists(F.concat(*BASE), lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))
    for kind in WEAK:
        weak = weak.withColumn(kind, F.filter(kind, apart))
    base = F.concat(*(_named(k, i) for i, k in enumerate(BASE)))
    candidates = F.size("bare") + F.size("endpoint") + F.size("account") > 0
    scanned, _ = written(
        weak.select("id", "key", *KINDS, base.alias("base"), candidates.alias("open")), "secret-parts")
    ties = linked(scanned.where("open").dropDuplicates(["key"]), scope)
    opened = scanned.where("open").join(ties, "key", "left").select("id", *BASE, "base", "found")
    closed = scanned.where("not open").select("id", *BASE, "base", F.lit(None).cast(opened.schema["found"].dataType).alias("found"))
    listed = F.coalesce("found", F.filter("base", lambda x: F.lit(False)))
    return opened.unionByName(closed).select(
        F.col("id").alias(doc_id), *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat("base", listed)).alias("spans"), F.size(listed).cast("long").alias("n_linked"))
