"""Classes of documents with alike spot signatures, in DataFrame functions only.

Two documents link when the Jaccard likeness of their fingerprints (sets of spot
signatures, see :mod:`.spotsigs`) is at least ``percent`` hundredths; documents
that links connect form a class.

1. *Partition.* Equal fingerprints are one set. Sets are partitioned by length:
   ``percent`` 80 needs lengths within a factor of 1.25, so a set meets only its
   own length partition and the next.
2. *Prune.* In one global order, frequent signatures last, two sets that link share
   two of the first ``n - ceil(percent n / 100) + 2`` signatures of the longer
   with two of the first ``n - ceil(2 percent n / (100 + percent)) + 2`` of the
   shorter (one, if they need to share no more). A bucket is a length partition
   with one of these signatures; those with a single set end here. At the second
   signature two sets share, what is left of either bounds their overlap; pairs
   whose bound is too small are not made.
3. *Lead.* Every set is compared, whole, with the least and the greatest set that
   its buckets hold most often. That is linear in a bucket of any size, and joins
   nearly all sets of a group of copies into one class.
4. *Rest.* Only buckets whose sets are still in several classes are opened, and
   there only pairs of different classes are compared; one of the two is never of
   the bucket's most common class. So no link between two classes is missed, and
   no pair within a class is made. Long sets share one signature by chance; pairs
   that meet in fewer buckets than a link needs end here.

Before whole sets are sent to each other, their sketches (a bit or more for each
signature, 512 at least) are: pairs whose sketches differ in more bits than a link
allows are no links.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.staging import stage_table
from .components import connected_components
from .spotsigs import _let, spot_signatures

#: Cells of the table of frequencies that orders signatures (64 kB, by their low bits).
CELLS = 1 << 16
#: Longs of the smallest sketch, and how often it may grow fourfold.
WORDS, GROWS = 8, 6
#: Signatures of two heads that a link shares, if it shares as many.
MET = 2
#: Pairs of one set that a slot of the comparison takes.
SLOT_PAIRS = 256
#: Documents of one fingerprint that one task takes in a join, unless they are more than 1 in 100,000 rows.
TOGETHER = 256


def _least_overlap(x, percent: int) -> Column:
    return F.ceil(F.lit(percent) * x / F.lit(100))


def _overlap(n, m, percent: int) -> Column:
    """Signatures that sets of n and m must share at least to link."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))


def _levels(signed: DataFrame) -> bytearray:
    """For each cell the logarithm of how often its signatures occur, against the
    mean; 0 below twice of it. It orders signatures, which decides speed and never
    results."""
    total = signed.agg(F.sum("n")).first()[0] or 0
    cells = signed.select(F.explode("spots").alias("x")).groupBy(F.col("x").bitwiseAND(F.lit(CELLS - 1)).alias("cell")).count()
    out = bytearray(CELLS)
    for r in cells.filter(F.col("count") * CELLS >= 2 * total).collect():  # CELLS / 2 rows at most
        out[r["cell"]] = (r["count"] * CELLS // total).bit_length()
    return out


def _heads(signed: DataFrame, prints: DataFrame, levels: bytearray, percent: int) -> DataFrame:
    """(x, part, rep, n, at, short, low, high): the signatures of the heads in buckets of
    several sets. A set stands in its own length partition, as the shorter one of a
    pair if ``short``, and as the longer one also in the partition below. ``low`` and
    ``high`` are the bucket's least and greatest (rep, n, at)."""
    level = lambda x: F.substr(F.lit(levels), x.bitwiseAND(F.lit(CELLS - 1)).cast("int") + 1, F.lit(1))
    ordered = F.array_sort(F.transform("spots", lambda x: F.struct(level(x).alias("level"), x.alias("x"))))
    n = F.col("n")
    head = F.transform(F.slice(ordered, F.lit(1), (n - _least_overlap(n, percent) + MET).cast("int")), lambda s: s["x"])
    heads = signed.select(F.col("row").alias("rep"), "n", head.alias("head")).join(prints.select("rep"), "rep")
    heads = heads.select("rep", "n", F.posexplode("head").alias("at", "x"))
    same = Window.partitionBy("x")  # most signatures have one set, and end here
    heads = heads.select("*", F.min("rep").over(same).alias("r1"), F.max("rep").over(same).alias("r2")).filter("r1 <> r2")
    base = math.log(100 / percent) if percent < 100 else 0.0
    part = F.floor(F.log(n.cast("double")) / base + F.lit(1e-9)) if base else n
    short = F.col("at") < n - F.ceil(F.lit(2 * percent) * n / F.lit(100 + percent)) + MET
    out = heads.select("rep", "n", "at", "x", part.cast("int").alias("own"), F.explode(F.array(F.lit(0), F.lit(1))).alias("below"))
    out = out.select("x", (F.col("own") - F.col("below")).alias("part"), "rep", "n", "at", (short & (F.col("below") == 0)).alias("short"))
    bucket, one = Window.partitionBy("x", "part"), F.struct("rep", "n", "at")
    return out.select("*", F.min(one).over(bucket).alias("low"), F.max(one).over(bucket).alias("high")).filter("low.rep <> high.rep")


def _may_link(a: str, b: str, percent: int, before: int = 0) -> Column:
    """Whether the lengths and the places of a shared signature let two sets link, if
    they share at most ``before`` earlier ones (``at`` counts from 0)."""
    n, m = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    bound = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))
    return (n * 100 >= m * percent) & (bound + before >= _overlap(n, m, percent))


def _sketch(spots) -> Column:
    """Parity of the signatures by their low bits, one bit each, in ``WORDS`` longs, or
    four times as many while there are more signatures than bits."""
    one = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)))
    parity = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda bits, x: bits.bitwiseXOR(one(x)))
    word = lambda xs, by, k, of: F.filter(xs, lambda x: F.shiftright(x, by).bitwiseAND(F.lit(of - 1)) == k)
    words = F.array(*(word(spots, 6, k, WORDS) for k in range(WORDS)))
    for grown in range(GROWS):  # long k of w is split into k, k + w, k + 2 w and k + 3 w
        w = WORDS << 2 * grown
        split = lambda ws: F.flatten(F.array(*(F.transform(ws, lambda xs: word(xs, 5 + w.bit_length(), k, 4)) for k in range(4))))
        words = _let(words, lambda ws: F.when(F.size(spots) > 64 * w, split(ws)).otherwise(ws))
    return F.transform(words, parity)


def _folded(bits, words) -> Column:
    """The sketch that a set has in so many longs, from one of as many or more."""
    fold = lambda k: F.aggregate(F.sequence(k, F.size(bits) - 1, words), F.lit(0).cast("long"), lambda s, i: s.bitwiseXOR(F.get(bits, i)))
    return F.when(F.size(bits) == words, bits).otherwise(F.transform(F.sequence(F.lit(0), words - 1), fold))


def _near(sketches: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sketches differ in no more bits than a link
    allows. Sets differ in at least as many signatures as their sketches in bits."""
    x = sketches.select(F.col("row").alias("a"), "n", F.col("bits").alias("x"))
    y = sketches.select(F.col("row").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
    words = F.least(F.size("x"), F.size("y"))
    differ = F.zip_with(_folded(F.col("x"), words), _folded(F.col("y"), words), lambda v, w: F.bit_count(v.bitwiseXOR(w)))
    apart = F.aggregate(differ, F.lit(0), lambda s, c: s + c)
    allowed = F.col("n") + F.col("m") - 2 * _overlap(F.col("n"), F.col("m"), percent)
    return pairs.join(x, "a").join(y, "b").filter(apart <= allowed).select("a", "b")


def _verified(signed: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets link. A set with many pairs is
    copied over several slots, so no task gets all of them."""
    slots = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(SLOT_PAIRS)).cast("int").alias("slots"))
    slots = stage_table(slots, "spot-slots")
    sets = signed.select("row", "spots")
    one = (sets.withColumnRenamed("row", "a").join(slots, "a")
           .select("a", F.col("spots").alias("x"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot")))
    ends = pairs.join(slots, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("slots")).cast("int").alias("slot"))
    two = sets.withColumnRenamed("row", "b").join(ends, "b").select("a", "b", "slot", F.col("spots").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    found = two.join(one, ["a", "slot"]).select("a", "b", both.alias("both"), (F.size("x") + F.size("y") - both).alias("any"))
    return found.filter(F.lit(100) * F.col("both") >= F.lit(percent) * F.col("any")).select("a", "b")


def _led(shared: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: every set with the least and the greatest set of its buckets,
    each the one that most of the buckets have where it may link."""
    parts = []
    for end in ("low", "high"):
        met = shared.alias("s").filter((F.col("rep") != F.col(f"{end}.rep")) & _may_link("s", end, percent))
        met = met.groupBy("rep", F.col(f"{end}.rep").alias("led")).count()
        parts.append(met.groupBy("rep").agg(F.max(F.struct("count", "led")).alias("m")).select("rep", "m.led"))
    pairs = parts[0].unionByName(parts[1])
    return pairs.select(F.least("rep", "led").alias("a"), F.greatest("rep", "led").alias("b")).distinct()


def _rest(shared: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: pairs of different classes that share as many buckets as a link
    needs, where the lengths and the places of their signature let them link."""
    own = shared.join(classes, F.col("rep") == F.col("node"), "left").withColumn("cls", F.coalesce("component", "rep"))
    own = stage_table(own.select("x", "part", "rep", "n", "at", "short", "cls"), "spot-members")
    held = own.groupBy("x", "part", "cls").count().groupBy("x", "part").agg(
        F.count("*").alias("c"), F.max(F.struct("count", "cls")).alias("m")).filter("c > 1").select("x", "part", F.col("m.cls").alias("top"))
    members = stage_table(own.join(held, ["x", "part"]), "spot-mixed")
    a, b = members.filter("cls <> top").alias("a"), members.drop("top").alias("b")
    first = (F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.rep") < F.col("b.rep")))
    roles = (first & F.col("a.short")) | (~first & F.col("b.short"))
    pairs = a.join(b, (F.col("a.x") == F.col("b.x")) & (F.col("a.part") == F.col("b.part"))
                   & (F.col("a.cls") != F.col("b.cls")) & roles & _may_link("a", "b", percent, MET - 1)
                   & (first | (F.col("b.cls") == F.col("a.top"))))  # once in a bucket
    need = F.least(F.lit(MET), _overlap(F.col("a.n"), F.col("b.n"), percent)).cast("byte")
    pairs = pairs.select(F.least("a.rep", "b.rep").alias("a"), F.greatest("a.rep", "b.rep").alias("b"), need.alias("need"))
    return pairs.groupBy("a", "b", "need").count().filter("count >= need").select("a", "b")


def spot_classes(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hash, class_id) of the rows whose class has a smaller id than their
    own (or an id at all, if they have none); ``hash`` is the xxhash64 of the text.
    All other rows are their own class.

    ``class_id`` is the smallest id of the rows that links reach. Rows, not ids,
    are linked: rows that repeat an id are classed each by its own text. Null and
    empty texts and texts without words link with nothing. Ids are integers; other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    signed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"),
                         F.transform(spot_signatures(text), lambda x: (x - (1 << 31)).cast("int")).alias("spots"))
    signed = stage_table(signed.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "hash", F.size("spots").alias("n"),
        F.xxhash64("spots").alias("fp1"), F.xxhash64(F.lit(1), "spots").alias("fp2"), "spots"), "spot-sets").filter("n > 0")
    same = ["n", "fp1", "fp2"]
    prints = stage_table(signed.groupBy(*same).agg(
        F.min("row").alias("rep"), F.min("doc_id").alias("least"), F.count("*").alias("c")), "spot-prints")
    shared = stage_table(_heads(signed, prints, _levels(signed), percent), "spot-shared")
    sketches = stage_table(signed.select("row", "n", _sketch(F.col("spots")).alias("bits")), "spot-sketches")
    led = stage_table(_near(sketches, _led(shared, percent), percent), "spot-led")
    links = stage_table(_verified(signed, led, percent), "spot-links")
    classes = stage_table(connected_components(links, "a", "b"), "spot-classes")
    rest = _near(sketches, _rest(shared, classes, percent).join(led, ["a", "b"], "left_anti"), percent)
    rest = stage_table(rest, "spot-rest")
    if not rest.isEmpty():
        more = stage_table(_verified(signed, rest, percent), "spot-more")
        if not more.isEmpty():
            classes = stage_table(connected_components(links.unionByName(more), "a", "b"), "spot-classes")

    named = prints.join(classes.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    ids = named.groupBy("component").agg(F.min("least").alias("class_id"), F.sum("c").alias("rows")).filter("rows > 1").drop("rows")
    named = stage_table(named.join(ids, "component").select(*same, "c", "class_id"), "spot-named")
    # Fingerprints of more than 1 in 100,000 rows are 100,000 at most (4 MB).
    many = F.col("c") > max(TOGETHER, signed.count() // 100_000)
    rows = signed.select("doc_id", "hash", *same)
    found = rows.join(F.broadcast(named.filter(many)), same).unionByName(rows.join(named.filter(~many), same))
    found = found.filter(~F.col("class_id").eqNullSafe(F.col("doc_id")))
    return stage_table(found.groupBy("doc_id", "hash").agg(F.min("class_id").alias("class_id")), "spot-rows")

