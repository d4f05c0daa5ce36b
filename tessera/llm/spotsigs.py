"""Document fingerprints: SpotSigs, in DataFrame and SQL functions only.

A spot signature is a common word (the anchor) with the chain of the next two
content words behind it. Common words of four languages are anchors; so is
every sixteenth content word by hash, which gives texts without common words
(tables, lists) signatures as well. A fingerprint is the set of a text's
signatures (32-bit hashes); a text without a complete chain has one signature,
the hash of all its words, and a text without words has none.

Two fingerprints compare by the Jaccard likeness of their sets. For joins,
fingerprints are partitioned by set length: likeness t needs lengths within a
factor t, so a fingerprint meets only its own and the next length partition,
there only by the first ``n - ceil(t n) + 1`` of its signatures in one global
order, and candidates are compared in full.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Anchors: common words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was "
    "we were which with you au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous ou par pas pour que "
    "qui sa se ses son sur un une vous auf aus bei das dass dem den der des die ein eine einem einen einer er es für im ist mit "
    "nicht sich sie sind und von wie wird zu zum zur al como con del el ella era esta este ha lo las los más no para pero por si "
    "sin su sus también una y"
).split()
#: Rows of a range of ids that one window orders, about.
ROWS = 4096
#: Steps between quantiles of the ids, at most.
STEPS = 1 << 12
#: Id ranges, at most about; their first ids are broadcast (8 MB).
RANGES = 1 << 18


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def spot_signatures(text: Column) -> Column:
    """The sorted set of a text's spot signatures (array<long>, 32 bits each)."""
    plain = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    anchor = lambda w: w.isin(ANCHORS) | (F.pmod(F.hash(w), F.lit(16)) == 0)
    bits = lambda h: h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))

    def spots(words: Column) -> Column:
        # An anchor at position p with k anchors before it has p - k content words before it.
        at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: anchor(F.get(words, i)))
        rest = F.filter(words, lambda w: ~anchor(w))
        chain = lambda c: F.transform(at, lambda p, k: F.when(
            p - k + 2 <= F.size(c), bits(F.hash(F.get(words, p), F.get(c, p - k), F.get(c, p - k + 1)))))
        return _let(rest, lambda c: F.array_sort(F.array_distinct(F.array_compact(chain(c)))))

    found = _let(F.split(plain, " "), spots)
    whole = F.array(bits(F.hash(plain)))
    return F.when(plain == "", F.array().cast("array<long>")).otherwise(
        _let(found, lambda f: F.when(F.size(f) > 0, f).otherwise(whole)))


def as_text(signatures: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits for each signature."""
    return F.array_join(F.transform(signatures, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets; 1 for two empty ones."""
    both = lambda n: F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(n / (F.size(a) + F.size(b) - n))
    return _let(F.size(F.array_intersect(a, b)), both)


def _array(values: list, kind: str = "L") -> str:
    """SQL of an array of numbers, ``L`` (long) or ``D`` (double) ones."""
    return f"array({', '.join(f'{v}{kind}' for v in values)})"


def _cuts(keys: DataFrame, rows: int) -> list[int]:
    """First ids of steps that hold about equal numbers of rows, 4,096 at most,
    by the table's quantiles. An id that fills half a step has one of its own.
    Quantiles are doubles, so up to 1,024 adjacent ids may stay together."""
    count = keys.count()
    steps = min(STEPS, max(1, -(-count // rows)))
    if steps == 1:
        return []
    shares = [i / steps for i in range(1, steps)]
    found = keys.agg(F.percentile_approx("doc_id", shares, 4 * STEPS)).first()[0] or []
    twice = sorted({x for x, after in zip(found, found[1:]) if x == after})
    hot = []
    if twice:  # 2 * STEPS ids at most
        near = keys.filter(F.col("doc_id").cast("double").isin([float(x) for x in twice]))
        hot = [r[0] for r in near.groupBy("doc_id").count().filter(F.col("count") * 2 * steps >= count).collect()]
    return sorted({*found, *hot, *(x + 1 for x in hot if x < (1 << 63) - 1)})


def _step(key: Column, cuts: list[int]) -> Column:
    """0 for a null key, else 1 more than the number of ``cuts`` up to it. Looked
    up in two levels of at most 64 comparisons each."""
    if not cuts:
        return F.when(key.isNull(), 0).otherwise(1)
    size = math.isqrt(len(cuts) - 1) + 1
    groups = [cuts[i : i + size] for i in range(0, len(cuts), size)]
    up_to = lambda values: F.size(F.filter(values, lambda x: x <= key))
    within = F.expr(f"array({', '.join(map(_array, groups))})")
    at = _let(up_to(F.expr(_array([g[0] for g in groups]))), lambda g: F.when(g == 0, 1).otherwise(
        1 + (g - 1) * size + up_to(F.element_at(within, F.greatest(g, F.lit(1))))))
    return F.when(key.isNull(), 0).otherwise(at)


def _ranged(docs: DataFrame, rows: int, also: DataFrame | None = None):
    """``docs`` (doc_id, text) with ``part``, the range of a row in the order of
    (doc_id, hash), and ``hash``. Steps between quantiles are cut further by how
    many rows they hold: by id, or, in a step of one id (or of none), by the
    hash of the text, so neither outliers nor an id with many rows fill a range.
    With ``also`` (doc_id, text_hash) a pair: its rows are dealt the same way."""
    cuts = _cuts(docs.select("doc_id"), rows)
    step = docs.withColumn("step", _step(F.col("doc_id"), cuts))
    # One row for each step, 8,194 at most.
    held = {r["step"]: r for r in step.groupBy("step").agg(F.count("*").alias("c"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).collect()}
    rows = max(rows, -(-sum(r["c"] for r in held.values()) // RANGES))
    n = max(held, default=0) + 1
    parts = [max(1, -(-held[i]["c"] // rows)) if i in held else 0 for i in range(n)]
    low = [held[i]["low"] or 0 if i in held else 0 for i in range(n)]
    width = [float(held[i]["high"] - held[i]["low"]) if i in held and held[i]["low"] is not None else 0.0 for i in range(n)]
    first = [sum(parts[:i]) for i in range(n)]
    pick = lambda values, kind="L": F.get(F.expr(_array(values, kind)), F.col("step"))
    number = lambda c: c.cast("double")
    inside = (number(F.col("doc_id")) - number(pick(low))) / F.nullif(pick(width, "D"), F.lit(0.0))
    # The text is read for this only if a step of one id (or of none) is cut.
    hashed = any(p > 1 and not w for p, w in zip(parts, width))

    def deal(df: DataFrame, text_hash: Column) -> DataFrame:
        df = df.withColumn("hash", text_hash if hashed else F.lit(0).cast("long"))
        at = F.coalesce(inside, number(F.col("hash")) / F.lit(2.0**64) + F.lit(0.5))
        cut = F.greatest(F.lit(0), F.least(F.floor(at * pick(parts)), pick(parts) - 1))
        return df.withColumn("part", (pick(first) + cut).cast("long")).drop("step")

    dealt = deal(step, F.xxhash64("text"))
    return dealt if also is None else (dealt, deal(also.withColumn("step", _step(F.col("doc_id"), cuts)), F.col("text_hash")))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS,
                          classes: DataFrame | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next; with
    ``classes`` (doc_id, hash, class_id; see :func:`.spot_classes.spot_classes`)
    also class_id, of the row with the same id and hash of the text, else doc_id.

    The edited text replaces the last quarter of a text's code points by the
    first as many of the next document, by ascending id (rows without an id
    first, repeated ids by hash of the text; after the last row comes the
    first). Any 64-bit id will do. A null text counts as empty. Other columns
    are ignored; an empty table gives no rows.

    Ids are dealt into ranges of about ``rows`` rows, each ordered by itself;
    the first rows of a range are also sent to the range before it, so every
    row meets its next one with a single shuffle of the texts. Only rows that
    repeat both id and text always share a range. Classes are dealt with the texts,
    so they cost no further shuffle of these.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if classes is None:
        docs = _ranged(docs, rows)
    else:
        docs, classes = _ranged(docs, rows, classes.select("doc_id", F.col("hash").alias("text_hash"), "class_id"))
    key = F.struct("doc_id", "hash")
    firsts = docs.groupBy("part").agg(F.min(key).alias("least"))
    order = Window.orderBy("part")  # at most RANGES + 8,194 rows of three numbers
    firsts = firsts.select("part", "least", F.coalesce(F.lag("part").over(order), F.max("part").over(Window.partitionBy())).alias("before"))
    sent = (docs.join(F.broadcast(firsts), "part")
            .withColumn("to", F.explode(F.array_compact(F.array(
                F.struct(F.col("part").alias("part"), F.lit(False).alias("extra")),
                F.when(key.eqNullSafe(F.col("least")), F.struct(F.col("before").alias("part"), F.lit(True).alias("extra")))))))
            .select("doc_id", "text", "to.part", "to.extra"))
    if classes is None:
        sent = sent.repartition("part")
    else:
        sent = sent.unionByName(classes.select("doc_id", "part", "text_hash", "class_id"), allowMissingColumns=True).repartition("part")
        alike = Window.partitionBy("part", "doc_id", "text_hash")
        sent = sent.withColumn("text_hash", F.coalesce("text_hash", F.xxhash64("text")))
        sent = sent.withColumn("class_id", F.max("class_id").over(alike)).filter("text is not null")
    kept = [] if classes is None else [F.coalesce("class_id", "doc_id").alias("class_id")]
    signed = sent.withColumn("spots", spot_signatures(F.col("text")))
    follow = Window.partitionBy("part").orderBy("extra", "doc_id", F.xxhash64("text"), "text")
    both = (signed.select("doc_id", "text", *kept, "spots", "extra", F.lead("text").over(follow).alias("next"),
                          F.lead("spots").over(follow).alias("next_spots")).filter("not extra"))
    n = F.length("text")
    edited = F.concat(F.substr("text", F.lit(1), n - F.floor(n / 4)), F.substr("next", F.lit(1), F.floor(n / 4)))
    both = both.withColumn("edited", edited).withColumn("edited_spots", spot_signatures(F.col("edited")))
    return both.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("spots")).alias("fingerprint"), as_text(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"), *kept)


def similar_pairs(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, likeness): pairs of different fingerprints that are at least so
    alike, each by the smallest id that has it. Copies of one fingerprint share
    its row in ``representatives``; texts without words are left out.
    """
    sets = representatives(docs, id_col, text_col).select("rep", "spots").distinct().filter(F.size("spots") > 0)
    n = F.size("spots")
    base = -math.log(least)
    part = F.floor(F.log(n) / base) if base > 0 else n
    head = F.slice(F.array_sort(F.transform("spots", lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("x")))), F.lit(1),
                   n - F.ceil(F.lit(least) * n) + 1)
    heads = sets.select("rep", n.alias("n"), part.alias("part"), F.explode(head).alias("spot")).select("rep", "n", "part", "spot.x")
    left, right = heads.alias("l"), heads.withColumn("part", F.explode(F.array("part", F.col("part") - 1))).alias("r")
    fits = (F.col("l.n") < F.col("r.n")) | ((F.col("l.n") == F.col("r.n")) & (F.col("l.rep") < F.col("r.rep")))
    close = F.col("l.n") >= F.lit(least) * F.col("r.n")
    found = left.join(right, (F.col("l.x") == F.col("r.x")) & (F.col("l.part") == F.col("r.part")) & fits & close)
    pairs = found.select(F.col("l.rep").alias("p"), F.col("r.rep").alias("q")).distinct()
    one, two = sets.select(F.col("rep").alias("p"), F.col("spots").alias("s")), sets.select(F.col("rep").alias("q"), F.col("spots").alias("t"))
    out = pairs.join(one, "p").join(two, "q").withColumn("likeness", likeness(F.col("s"), F.col("t"))).filter(F.col("likeness") >= least)
    return out.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "likeness")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rep, spots): each document's fingerprint and the smallest id that has the same one."""
    signed = docs.select(F.col(id_col).alias("doc_id"), spot_signatures(F.col(text_col).cast("string")).alias("spots"))
    signed = signed.withColumn("same", F.sha2(as_text(F.col("spots")), 256))
    return signed.join(signed.groupBy("same").agg(F.min("doc_id").alias("rep")), "same").select("doc_id", "rep", "spots")
