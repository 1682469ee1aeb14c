"""Problem 9: sources combined to target shares of the tokens, small sources repeated at most so many times.

Method: entropy balancing. Among all document rates that give every source its tokens, those nearest to one copy each
(in relative entropy) are exponentially tilted: rate = exp(lambda_s * tokens), cut off at the source's cap. The convex
dual is solved by Newton iterations; each is one aggregation over the corpus, of which a row for each source comes to
the driver. The rates are then rounded to copies by a hash of the document id, with a shift for each source, so that
the tokens of the copies come as near to the source's tokens as its documents allow.

The total is `total_tokens`, by default what the sources with a target hold. A source that cannot give its share even
at its cap gives all it can; the others share the rest in proportion to their targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrand.llm.tokens import VOCABULARY, token_counts
from lodestrand.session import materialise

ITERATIONS, TOLERANCE = 60, 1e-9
BINS = 8192  # resolution of the rounding shift


def allot(total: float, share: dict[str, float], most: dict[str, float]) -> dict[str, float]:
    """Tokens of each source: total in proportion to share, none above `most`; what one cannot take goes to the others."""
    out, free, rest = {}, dict(share), total
    while free:
        sum_ = sum(free.values())
        full = [s for s, w in free.items() if sum_ <= 0 or rest * w / sum_ >= most[s]]
        if not full:
            return out | {s: rest * w / sum_ for s, w in free.items()}
        for s in full:
            out[s] = most[s] if sum_ > 0 else 0.0
            rest -= out[s]
            del free[s]
    return out


def solve(histogram: DataFrame, want: dict[str, float], cap: dict[str, int], scale: dict[str, float]) -> dict[str, float]:
    """lambda of each source. histogram: (source, tokens, docs), with tokens > 0. Newton steps, kept within a bracket."""
    spark = histogram.sparkSession
    lam = {s: 0.0 for s in want}
    low: dict[str, float] = {}
    high: dict[str, float] = {}
    live = set(want)
    for _ in range(ITERATIONS):
        if not live:
            break
        rows = spark.createDataFrame([(s, lam[s], float(cap[s]), scale[s]) for s in sorted(live)], "source string, lam double, cap double, scale double")
        x = F.col("tokens") / F.col("scale")
        tilt = F.least(F.exp(F.least(F.col("lam") * x, F.lit(50.0))), F.col("cap"))
        inner = F.when(tilt < F.col("cap"), tilt).otherwise(0.0)
        got = histogram.join(F.broadcast(rows), "source").groupBy("source").agg(F.sum(F.col("docs") * F.col("tokens") * tilt).alias("f"), F.sum(F.col("docs") * F.col("tokens") * x * inner).alias("d"))
        for r in got.collect():  # a row for each source with a target
            s, gap = r["source"], r["f"] - want[r["source"]]
            if abs(gap) <= TOLERANCE * max(1.0, want[s]):
                live.discard(s)
                continue
            (high if gap > 0 else low)[s] = lam[s]
            step = lam[s] - gap / r["d"] if r["d"] else None
            if s in low and s in high:
                inside = step is not None and low[s] < step < high[s]
                lam[s] = step if inside else (low[s] + high[s]) / 2
                if high[s] - low[s] < 1e-12 * max(1.0, abs(lam[s])):
                    live.discard(s)
            else:
                bound = 2 * abs(lam[s]) + 1
                lam[s] = max(-bound - 1, min(bound + 1, step)) if step is not None else lam[s] + (-bound if gap > 0 else bound)
    return lam


def copies(
    documents: DataFrame, targets: DataFrame, *, total_tokens: int | None = None, doc: str = "doc_id", text: str = "text", source: str = "source", vocabulary: str = VOCABULARY
) -> DataFrame:
    """(doc_id, source, tokens, rate, copies) of every document.

    copies lies between 0 and the source's max_repeats. Documents without a source, with a source that has no target, or
    without tokens (NULL or empty text) get rate 0 and no copies. Repeated ids are different documents of equal rounding.
    targets: (source, target_share, max_repeats), few rows; NULL or negative shares count as 0, NULL max_repeats as 1.
    """
    spark = documents.sparkSession
    # Counted where the row stands: ids need not be unique and nothing is joined.
    flat = documents.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"))
    docs = materialise(token_counts(flat, vocabulary=vocabulary, keep="source"), "p9-tokens")
    wish = {r["source"]: (max(0.0, r["target_share"] or 0.0), max(0, 1 if r["max_repeats"] is None else int(r["max_repeats"]))) for r in targets.select("source", "target_share", "max_repeats").collect() if r["source"] is not None}
    known = docs.filter(F.col("source").isin(sorted(wish)) & (F.col("tokens") > 0))
    histogram = materialise(known.groupBy("source", "tokens").agg(F.count("*").alias("docs")), "p9-histogram")
    held = {r["source"]: (float(r["tokens"]), int(r["docs"])) for r in histogram.groupBy("source").agg(F.sum(F.col("tokens") * F.col("docs")).alias("tokens"), F.sum("docs").alias("docs")).collect()}
    used = {s: w for s, w in wish.items() if s in held and w[0] > 0 and w[1] > 0}
    total = float(total_tokens) if total_tokens is not None else sum(held[s][0] for s in held)
    most = {s: held[s][0] * used[s][1] for s in used}
    want = allot(total, {s: w[0] for s, w in used.items()}, most)
    full = {s for s in used if want[s] >= most[s] * (1 - 1e-12)}
    scale = {s: held[s][0] / held[s][1] for s in used}
    lam = solve(histogram, {s: want[s] for s in used if s not in full and want[s] > 0}, {s: used[s][1] for s in used}, scale)
    rows = [(s, lam.get(s, 0.0), float(used[s][1]), scale[s], s in full, float(want[s])) for s in sorted(used)]
    plan = F.broadcast(spark.createDataFrame(rows, "source string, lam double, cap double, scale double, full boolean, want double"))
    tilt = F.least(F.exp(F.least(F.col("lam") * F.col("tokens") / F.col("scale"), F.lit(50.0))), F.col("cap"))
    usable = F.col("cap").isNotNull() & (F.col("tokens") > 0) & (F.col("want") > 0)
    rated = docs.join(plan, "source", "left").withColumn("rate", F.when(usable, F.when(F.col("full"), F.col("cap")).otherwise(tilt)).otherwise(0.0))
    u = (F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    rated = rated.withColumn("whole", F.floor("rate")).withColumn("gap", u - (F.col("rate") - F.col("whole")))  # one more copy where gap < shift
    bins = rated.filter((F.col("rate") > 0) & (F.col("whole") < F.col("cap"))).groupBy("source", F.floor((F.col("gap") + 1) * (BINS / 2)).alias("bin")).agg(F.sum("tokens").alias("tokens"))
    base = {r["source"]: float(r["b"]) for r in rated.filter("rate > 0").groupBy("source").agg(F.sum(F.col("whole") * F.col("tokens")).alias("b")).collect()}
    shift = {s: -1.0 for s in used}
    by: dict[str, list[tuple[int, float]]] = {}
    for r in bins.collect():  # at most BINS rows for each source with a target
        by.setdefault(r["source"], []).append((int(r["bin"]), float(r["tokens"])))
    for s, pairs in by.items():
        left = want[s] - base.get(s, 0.0)
        for b, t in sorted(pairs):
            if t / 2 > left:  # half or more of this bin would be too much
                break
            left -= t
            shift[s] = (b + 1) / (BINS / 2) - 1
    shifts = F.broadcast(spark.createDataFrame([(s, v) for s, v in sorted(shift.items())], "source string, shift double"))
    more = F.when((F.col("rate") > 0) & (F.col("whole") < F.col("cap")) & (F.floor((F.col("gap") + 1) * (BINS / 2)) < F.round((F.col("shift") + 1) * (BINS / 2))), 1).otherwise(0)
    return rated.join(shifts, "source", "left").select("doc_id", "source", "tokens", "rate", (F.col("whole") + more).cast("bigint").alias("copies"))


def shares(copied: DataFrame, targets: DataFrame) -> DataFrame:
    """A row for each source with a target: what it holds, what the mix takes of it, its repeats and the share really reached."""
    per = copied.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum("tokens").alias("tokens"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum(F.col("copies") * F.col("tokens")).alias("mixed_tokens")
    )
    out = targets.select("source", "target_share", "max_repeats").join(F.broadcast(per), "source", "left").fillna(0, ["documents", "tokens", "copies", "most_copies", "mixed_tokens"])
    total = out.groupBy().agg(F.sum("mixed_tokens").alias("mix"))  # one row
    mix = total.first()["mix"] or 0
    share = F.when(F.lit(mix > 0), F.col("mixed_tokens") / F.lit(float(max(mix, 1)))).otherwise(0.0)
    return out.withColumn("repeats", F.when(F.col("tokens") > 0, F.col("mixed_tokens") / F.col("tokens")).otherwise(0.0)).withColumn("actual_share", share)
