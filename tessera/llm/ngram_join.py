"""N-gram Jaccard join over a token-group matrix.

Every document is the set of its distinct k-word shingles (64-bit hashes).
Two documents link when ``100 * |A n B| >= percent * |A u B|``; documents that
links connect form a class.

1. *Partition.* Sets of similar size that agree in their least shingle hash
   (over the frequent shingles, if those make up half of the set) form a
   group: near copies nearly always share it, and a group is just a label on
   rows, never gathered.
2. *Matrix.* A set's head is its first ``n - ceil(percent n / 100) + 1``
   shingles in one global order. The token-group matrix has one row for each
   shingle and group: the union of the members' heads, with the least and
   greatest member size.
3. *Bound.* Of two sets that link, the smaller one's first
   ``n - ceil(2 percent n / (100 + percent)) + 1`` shingles (its probe) meet
   the larger one's head. Probes join the matrix by shingle; the matches with
   a group's union bound the overlap with each member that is no smaller than
   the query, and groups whose bound misses the overlap that ``percent`` asks
   for stay closed.
4. *Open.* In an open group the query is compared, exactly and over whole
   sets, with the member that its shingles lead to most often, and with the
   second such member if the two are still in different classes. That is
   linear even in a group of thousands of copies, and links nearly all of
   them; only members in another class than the query are then taken one by
   one: first by their sketches inside the join, then exactly. No link
   between two classes can be missed: each has passed the bound, and the two
   ends are either in one class already or compared.

A set's sketch holds the parity of its shingles in each of ``n`` to ``2 n``
buckets, one bit each. Two sets differ in at least as many shingles as their
sketches differ in bits, so a pair whose sketches differ in more bits than a
link allows is no link, and its whole sets are never sent.

The global order only decides speed, never results: the most frequent of the
shingles that repeat within a partition (counted over all documents) come
last, all others by hash. Exact copies of a set are linked by its 128-bit fingerprint.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.staging import stage_table
from .components import connected_components
from .tasks import map_arrow
from .wordhash import chunks, int_lists, mix, shingle_sets, words_of

#: Shingles that are moved to the end of the global order, at most.
FREQUENT = 1 << 17
#: Shingles that the first scan holds before it counts them (4 MB).
MERGED = 1 << 19
#: Copies of one text that one task takes in a join, unless they are more than 1 in 100,000 rows.
TOGETHER = 256
#: Ids up to this many are broadcast to find documents again (32 MB), more are joined.
BROADCAST_IDS = 1 << 22
#: Pairs of one document that a slot of the exact comparison takes.
SLOT_PAIRS = 1 << 11


def _head(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    u = s.view(np.uint64)
    one = mix(u ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = mix(u + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def _sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the set's shingles by their low bits, in 64-bit words: a power of two of them."""
    words = 1 << max(0, (len(s) - 1).bit_length() - 6)
    odd = np.bincount(s & (64 * words - 1), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sets(batches, k: int):
    """(ids, sets) of each chunk of a (doc_id, text) batch."""
    for batch in batches:
        ids = batch.column(0)
        for first, data, offsets in chunks(batch.column(1)):
            yield ids.slice(first, len(offsets) - 1), shingle_sets(words_of(data, offsets), k)


def _scan_sizes(k: int):
    """(doc_id, n, fp1, fp2, frequent, sets): a row for each document, and a last
    row with the shingles that more than one of the partition's different sets
    holds, and in how many."""

    def merge(held, new):
        """Shingles that more than one of the sets since the last merge, or one and
        an earlier merge's, hold; both are sorted arrays of values and counts."""
        fresh = np.concatenate(new) if new else np.zeros(0, np.int64)
        new.clear()
        fresh.sort()
        first = np.flatnonzero(np.append(True, fresh[1:] != fresh[:-1])[: len(fresh)])
        counts = np.diff(np.append(first, len(fresh)))
        again = (counts > 1) | np.isin(fresh[first], held[0], assume_unique=True)
        values = np.concatenate([held[0], fresh[first[again]]])
        counts = np.concatenate([held[1], counts[again]])
        values, at = np.unique(values, return_inverse=True)
        return values, np.bincount(at, weights=counts, minlength=len(values)).astype(np.int64)

    def run(batches):
        seen, new, size = set(), [], 0
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for ids, sets in _sets(batches, k):
            prints = [_fingerprint(s) for s in sets]
            for s, fp in zip(sets, prints):
                if (key := hash(fp)) not in seen:  # 8 bytes of the 16; a false hit only costs a count
                    seen.add(key)
                    new.append(s)
                    size += len(s)
            if size > MERGED:
                held, size = merge(held, new), 0
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([fp[0] for fp in prints], pa.int64()), pa.array([fp[1] for fp in prints], pa.int64()),
                 pa.nulls(len(ids), pa.list_(pa.int64())), pa.nulls(len(ids), pa.list_(pa.int64()))],
                ["doc_id", "n", "fp1", "fp2", "frequent", "sets"])
        held = merge(held, new)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
             int_lists([held[0]]), int_lists([held[1]])],
            ["doc_id", "n", "fp1", "fp2", "frequent", "sets"])

    return run


def _scan_heads(k: int, percent: int, frequent: np.ndarray):
    """(doc_id, n, grp, head, bits) of the partition's different non-empty sets."""

    def split(s):
        if len(frequent) == 0:
            return s, s[:0]
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        late = frequent[at] == s
        return s[~late], s[late]

    def run(batches):
        seen = set()
        for ids, sets in _sets(batches, k):
            out = []
            for i, s in zip(ids.to_pylist(), sets):
                if len(s) and (fp := _fingerprint(s)) not in seen:
                    seen.add(fp)
                    early, late = split(s)
                    least = (late if len(late) >= len(early) else s)[:1].view(np.uint64)
                    grp = int(mix(least + np.uint64(np.log(len(s)) * 10))[0] >> np.uint64(32))
                    out.append((i, len(s), grp, np.concatenate([early, late])[: _head(len(s), percent)], _sketch(s)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                     pa.array([r[2] for r in out], pa.int64()), int_lists([r[3] for r in out]), int_lists([r[4] for r in out])],
                    ["doc_id", "n", "grp", "head", "bits"])

    return run


def _scan_sets(k: int):
    def run(batches):
        for ids, sets in _sets(batches, k):
            yield pa.RecordBatch.from_arrays([ids, int_lists(sets)], ["doc_id", "items"])

    return run


def _needed(n, m, percent: int):
    """Matches that heads must have at least if sets of n and m shingles link."""
    beyond = lambda x: F.ceil(F.lit(percent) * x / F.lit(100)) - 1
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent)) - F.greatest(beyond(n), beyond(m))


def _overlap(n, m, percent: int):
    """Shingles that sets of n and m must share at least to link."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))


def _may_link(x, y, n, m, percent: int):
    """False for sets of n and m shingles whose sketches x and y differ in more bits
    than a link allows. The longer sketch is folded once, to as many buckets as the
    other has; sketches further apart in length (percent under 50) rule nothing out."""
    short, long = F.when(F.size(x) <= F.size(y), x).otherwise(y), F.when(F.size(x) <= F.size(y), y).otherwise(x)
    half, xor = F.size(short), lambda a, b: a.bitwiseXOR(b)
    folded = F.when(F.size(long) == half, long).when(
        F.size(long) == 2 * half, F.zip_with(F.slice(long, 1, half), F.slice(long, half + 1, half), xor))
    apart = F.aggregate(F.zip_with(short, folded, lambda a, b: F.bit_count(xor(a, b))), F.lit(0), lambda s, c: s + c)
    return F.coalesce(apart, F.lit(0)) <= n + m - 2 * _overlap(n, m, percent)


def _sets_of(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(doc_id, items) of the documents in ``ids`` (doc_id, distinct, from a staged table)."""
    found = docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")
    return map_arrow(found.select("doc_id", "text"), _scan_sets(k), "doc_id long, items array<long>")


def _verified(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets link. The sets of the second
    ends are sent to the first ends, which many pairs share; a first end with
    many pairs is copied over several slots, so no task gets all of them."""
    slots = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(SLOT_PAIRS)).cast("int").alias("slots"))
    slots = stage_table(slots, "join-slots")
    ends = pairs.join(slots, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("slots")).cast("int").alias("slot"))
    ends = stage_table(ends, "join-ends")
    one = _sets_of(docs, slots.select(F.col("a").alias("doc_id")), k).withColumnsRenamed({"doc_id": "a", "items": "x"})
    one = one.join(F.broadcast(slots) if slots.count() <= BROADCAST_IDS // 4 else slots, "a")
    one = one.select("a", "x", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
    others = stage_table(ends.select(F.col("b").alias("doc_id")).distinct(), "join-ids")
    two = _sets_of(docs, others, k).withColumnsRenamed({"doc_id": "b", "items": "y"})
    two = two.join(F.broadcast(ends) if ends.count() <= BROADCAST_IDS // 4 else ends, "b")
    both = F.size(F.array_intersect("x", "y"))
    return (two.join(one, ["a", "slot"]).select("a", "b", both.alias("both"), (F.size("x") + F.size("y") - both).alias("any"))
            .filter(F.lit(100) * F.col("both") >= F.lit(percent) * F.col("any")).select("a", "b"))


def _copies(sizes: DataFrame) -> DataFrame:
    """(a, b): every id whose set another id has too, with the least such id. Sets
    that many ids share (more than 1 in 100,000 of them, so there are at most
    100,000 such sets, 5 MB) are broadcast; all others are joined."""
    sets = (sizes.groupBy("n", "fp1", "fp2").agg(F.min("doc_id").alias("b"), F.count("*").alias("c")).filter("c > 1"))
    sets = stage_table(sets, "join-copied")
    many = F.col("c") > max(TOGETHER, sizes.count() // 100_000)
    parts = [sizes.join(found.drop("c"), ["n", "fp1", "fp2"]).select(F.col("doc_id").alias("a"), "b").filter("a <> b")
             for found in (F.broadcast(sets.filter(many)), sets.filter(~many))]
    return parts[0].unionByName(parts[1])


def ngram_jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                          percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs``.

    ``component_id`` is the smallest id that links reach. Null and empty texts
    and texts of white space have no shingles and link with nothing. Rows that
    repeat an id count as one document: a row's class is its id's. A row
    without an id keeps its size and gets a null class. Ids are integers; other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kinds = "doc_id long, n long, fp1 long, fp2 long, frequent array<long>, sets array<long>"
    scan = stage_table(map_arrow(docs, _scan_sizes(k), kinds), "join-sizes")
    sizes = scan.filter("n is not null")
    top = (scan.filter("n is null").select(F.explode(F.arrays_zip("frequent", "sets")).alias("x"))
           .groupBy("x.frequent").agg(F.sum("x.sets").alias("c")).orderBy(F.desc("c"), "frequent").limit(FREQUENT))
    frequent = np.sort(top.select("frequent").toArrow().column(0).to_numpy())

    known = docs.filter("doc_id is not null")
    heads = stage_table(map_arrow(known, _scan_heads(k, percent, frequent),
                                         "doc_id long, n long, grp long, head array<long>, bits array<long>"), "join-heads")
    probe = F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / F.lit(100 + percent)) + 1
    tokens = (heads.select("doc_id", "n", "grp", F.posexplode("head").alias("at", "token"))
              .select("doc_id", "n", (F.col("grp") * 2 + (F.col("at") < probe).cast("long")).alias("tag"), "token")
              .repartition("token"))
    matrix = tokens.groupBy("token", F.shiftright("tag", 1).alias("grp")).agg(
        F.count("*").alias("members"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        F.min("n").alias("min_n"), F.max("n").alias("max_n"))
    matrix = matrix.withColumn("held", F.sum("members").over(Window.partitionBy("token")))
    fits = (F.col("m.max_n") >= F.col("t.n")) & (F.col("t.n") * 100 >= F.col("m.min_n") * percent)
    fits = fits & ~((F.col("m.members") == 1) & (F.col("m.low") == F.col("t.doc_id")))
    own = F.col("m.grp") == F.shiftright("t.tag", 1)
    # A filter on the probes would keep Spark from reading the matrix's shuffle of the tokens
    # again, so the condition takes its 1 from the matrix (members are 1 at least).
    probes = F.coalesce(F.col("t.tag") % 2, F.lit(0)) >= F.least("m.members", F.lit(1))
    hits = tokens.alias("t").join(
        matrix.alias("m"), (F.col("t.token") == F.col("m.token")) & (F.col("m.held") > 1) & probes & (fits | own))
    met = hits.groupBy(F.col("t.doc_id").alias("q"), F.col("m.grp").alias("grp")).agg(
        F.first("t.n").alias("n"), F.count_if(fits).alias("matches"), F.count_if(own).alias("shared"),
        F.mode(F.when(fits, F.col("m.low")), True).alias("low"), F.mode(F.when(fits, F.col("m.high")), True).alias("high"),
        F.min(F.when(fits, F.col("m.min_n"))).alias("min_n"), F.max(F.when(fits, F.col("m.max_n"))).alias("max_n"))
    most = F.least("max_n", F.floor(F.col("n") * 100 / F.lit(percent)))
    beyond = F.ceil(F.lit(percent) * F.col("n") / F.lit(100)) - F.ceil(F.lit(2 * percent) * F.col("n") / F.lit(100 + percent))
    bound = F.least(*(_needed(F.col("n"), m, percent) for m in (F.greatest("min_n", "n"), most))) + beyond
    met = met.withColumn("open", (F.col("matches") > 0) & (F.col("matches") >= bound)).filter("open or shared > 0")
    met = stage_table(met.select("q", "n", "grp", "shared", "open", "low", "high"), "join-open")
    opened = met.filter("open")
    n_open = opened.count()
    # Probe shingles of a document that another one has in its head. The others may still be
    # in a larger set's tail, but not in the tail of a smaller one that links with it.
    lone = met.filter("shared > 0").select(F.col("q").alias("doc_id"), "shared")

    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    copies = stage_table(_copies(sizes.filter("n > 0 and doc_id is not null")).distinct(), "join-copies")
    # Copies compare as the first of them; an id that repeats with other texts speaks for itself.
    firsts = copies.groupBy("a").agg(F.min("b").alias("first"), F.count("*").alias("c")).filter("c = 1").drop("c")

    def as_first(pairs: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = (pairs.join(firsts.withColumnRenamed("a", end), end, "left")
                     .withColumn(end, F.coalesce("first", end)).select("a", "b"))
        return pairs.select(*pair("a", "b")).filter("a <> b").distinct()

    def near(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) of sets in ``heads`` that their sketches leave."""
        pairs = pairs.filter("a <> b").distinct()
        pairs = F.broadcast(pairs) if n_open <= BROADCAST_IDS // 4 else pairs
        x, y = (heads.select(F.col("doc_id").alias(d), F.col("n").alias(n), F.col("bits").alias(bits)).join(pairs, d)
                for d, n, bits in (("a", "n", "x"), ("b", "m", "y")))
        return x.join(y, ["a", "b"]).filter(_may_link(F.col("x"), F.col("y"), F.col("n"), F.col("m"), percent)).select("a", "b")

    of = lambda df, key: (df.join(classes.withColumnRenamed("node", key), key, "left")
                          .withColumn("component", F.coalesce("component", key)))
    led = stage_table(as_first(near(opened.select(*pair("q", "low")))), "join-led")
    links = stage_table(copies.unionByName(_verified(known, led, k, percent)), "join-links")
    classes = stage_table(connected_components(links, "a", "b"), "join-classes")
    # The second of the two only where the first has left the two ends in different classes.
    also = as_first(near(opened.filter("high <> low").select(*pair("q", "high"))))
    also = of(of(also, "a").withColumnRenamed("component", "own"), "b").filter("component <> own").select("a", "b")
    also = stage_table(also.join(led, ["a", "b"], "left_anti"), "join-also")
    if not also.isEmpty():
        links = stage_table(links.unionByName(_verified(known, also, k, percent)), "join-links")
        classes = stage_table(connected_components(links, "a", "b"), "join-classes")
    led = led.unionByName(also)

    # Members of open groups that are still in another class than the query. The
    # only member of a group is the one that the query was compared with.
    spread = of(heads.select("doc_id", "grp"), "doc_id").groupBy("grp").agg(
        F.min("component").alias("c1"), F.max("component").alias("c2"), F.min("doc_id").alias("d1"), F.max("doc_id").alias("d2"))
    asks = (of(opened.select("q", "grp"), "q").withColumnRenamed("component", "own").join(spread, "grp")
            .filter("d1 <> d2 and (c1 <> own or c2 <> own)").select(F.col("q").alias("doc_id"), "own", "grp"))
    asks = stage_table(asks, "join-asks")
    # What is known of a member without its sketch, to send it to the sketches.
    about = of(heads.select("doc_id", "grp").distinct().join(asks.select("grp").distinct(), "grp", "left_semi"), "doc_id")
    about = stage_table(about.join(lone, "doc_id", "left").select("doc_id", "grp", "component", "shared"), "join-about")
    send = lambda df: F.broadcast(df) if df.count() <= BROADCAST_IDS // 8 else df
    can = F.col("n") - (probe - F.coalesce("shared", F.lit(0)))
    asked = heads.drop("grp", "head").join(send(asks), "doc_id").select(
        F.col("doc_id").alias("q"), "own", "grp", "n", F.col("bits").alias("x"))
    members = heads.drop("head").join(send(about), ["doc_id", "grp"]).select(
        F.col("doc_id").alias("s"), F.col("n").alias("m"), "grp", F.col("bits").alias("y"), "component", can.alias("can"))
    larger = (F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("q") < F.col("s")))
    fits = larger & (F.col("n") * 100 >= F.col("m") * percent) & (F.col("can") >= _overlap(F.col("n"), F.col("m"), percent))
    alike = _may_link(F.col("x"), F.col("y"), F.col("n"), F.col("m"), percent)
    rest = (asked.alias("l").join(members.alias("r"), (F.col("l.grp") == F.col("r.grp")) & (F.col("own") != F.col("component"))
                                  & fits & alike)
            .select(*pair("q", "s")))
    rest = as_first(rest).join(led, ["a", "b"], "left_anti")
    rest = stage_table(rest, "join-rest")
    if not rest.isEmpty():
        more = stage_table(_verified(known, rest, k, percent), "join-more")
        if not more.isEmpty():
            classes = connected_components(links.unionByName(more), "a", "b")
    joined = sizes.join(classes.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"),
                         F.coalesce("component", "doc_id").alias("component_id"))
