"""N-gram Jaccard join under several token orders (operator 5).

A text's set is its distinct five-word shingles (64-bit hashes; lower-cased A-Z; a
text of fewer words is one shingle).  Two texts link when their sets' Jaccard
similarity is at least ``PERCENT``.  Prefix filtering says: order all shingles in
any one way; linked sets then share a shingle among the first
``n - ceil(0.8 n) + 1`` of each.  Here this must hold under several orders at once.

1. *Classes.*  Texts of equal sets (128-bit digest) are one class from here on.
2. *First filter.*  The texts are read again, and from every class the 30 % of shingles with the smallest hash go
   to an aggregation that finds those no other class has.  A set in which more than
   ``n - ceil(0.8 n)`` shingles are its own cannot link to anything: it is done.
   That is the prefix filter under the order "rarest first", on a part of the
   shingles that is the same for all; what it drops is provably without partner.
3. *Orders.*  The rest (a few per cent of the texts) are reread, their shingles
   counted among themselves, and prefixes taken under ``ORDERS`` orders: by
   frequency, ties broken by another hash each.  Under each order, classes that
   share a prefix shingle are chained to that shingle's smallest class, and the
   chains' components computed; linked classes are in one component under every
   order, so the components are intersected.
4. *Verification.*  What remains are small groups.  A task holds whole groups (a
   large one is cut into blocks, and a task holds two blocks), finds the pairs
   that share prefix shingles under every order, and counts their intersection
   exactly unless links found before already connect them.  It emits one row for
   each class that links connect to a smaller one, never all pairs.
5. *Components* over all tasks' rows, back to all texts.

Hot groups: equal sets collapse first; all aggregations are partial before their
shuffle; groups are cut into blocks by their size.  Nothing is capped or sampled:
the bitmap that preselects texts in step 3 only lets too many through when full.

Cases: null text counts as empty; texts without words have an empty set, link with
nothing (not each other) and are their own component; rows with one id share what
their sets link to; a null id is never a component's id unless no row of it has one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quality_lake.sources import stage

from .common import ROW, as_files, free_names, mix64, placed, rows_of, slices, text_or_empty, utf8, word_hashes
from .components import components

WORDS, PERCENT, ORDERS = 5, 80, 3
#: Share of the hash range that the first filter looks at.
LOOK = 0.3
#: Digests that a task remembers, to describe a copy without its shingles.
SEEN = 1 << 16
#: Shingles in a block of a group, and in a task.
BLOCK_SHINGLES = 1 << 20
BITMAP_BITS = (1 << 16, 1 << 27)
#: When every link is asked for: sets that meet all others of a piece at once, common shingles that are counted at
#: once, and how many sets make a shingle common.
LINK_ROWS, COLUMNS, OFTEN = 512, 1024, 24

_STEP = np.uint64(0x100000001B3)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words_each: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a run."""
    words, counts = word_hashes(raw, offsets, lower=True)
    ends = np.cumsum(counts)
    first = ends - counts
    whole = max(0, len(words) - words_each + 1)
    h = words[:whole].copy()
    for k in range(1, words_each):
        h = h * _STEP + words[k:whole + k]
    h = mix64(h)
    out = []
    for a, n in zip(first.tolist(), counts.tolist()):
        if n >= words_each:
            own = np.sort(h[a:a + n - words_each + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            one = words[a:a + 1].copy()
            for k in range(1, n):
                one = one * _STEP + words[a + k:a + k + 1]
            out.append(mix64(one + np.uint64(n)))
        else:
            out.append(h[:0])
    return out


def digest(own: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers; equal sets, equal digests."""
    size = np.array([len(own)], np.uint64)
    k1 = mix64(np.bitwise_xor.reduce(mix64(own), keepdims=True) + size * _STEP) if len(own) else mix64(size)
    k2 = mix64(mix64(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True) + size)
    return int(k1.view(np.int64)[0]), int(k2.view(np.int64)[0])


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """ceil(n * percent / 100): what a set of n has in common with a linked one, at least."""
    return -(-n * percent // 100)


def _sets_of(batches):
    for batch in batches:
        for piece in slices(batch, "text"):
            yield piece, shingle_sets(*utf8(piece.column("text")))


def _seen_before(key: tuple[int, int], seen: set[tuple[int, int]]) -> bool:
    """Whether a set was met in this task; of bounded memory, so a copy may be taken for new and move once more."""
    if key in seen:
        return True
    if len(seen) >= SEEN:
        seen.clear()
    seen.add(key)
    return False


def described(docs: DataFrame) -> DataFrame:
    """``(ROW, doc_id, k1, k2, n)``: every row's set by digest and size."""
    def run(batches):
        for piece, sets in _sets_of(batches):
            keys = [digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                piece.column(ROW), piece.column("doc_id"), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64())], names=[ROW, "doc_id", "k1", "k2", "n"])

    return placed(docs).select(ROW, F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        run, f"{ROW} bigint, doc_id bigint, k1 bigint, k2 bigint, n bigint")


def looked_at(docs: DataFrame) -> DataFrame:
    """``(k1, tokens)``: of every class, the part of its set that the first filter looks at.
    Made anew from the texts and shuffled once: written down, it would take more disk than the texts' scan takes time."""
    limit = np.uint64(int(LOOK * 2**64))

    def run(batches):
        seen: set[tuple[int, int]] = set()
        for _, sets in _sets_of(batches):
            k1s, tokens = [], []
            for s in sets:
                key = digest(s)
                if len(s) and not _seen_before(key, seen):
                    k1s.append(key[0])
                    tokens.append(s[:np.searchsorted(s, limit)].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(k1s, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))], names=["k1", "tokens"])

    return docs.select(text_or_empty().alias("text")).mapInArrow(run, "k1 bigint, tokens array<bigint>")


def possible(docs: DataFrame, rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(cid, k1, k2, n)`` of the classes that the first filter leaves, numbered."""
    owners = looked_at(docs).select("k1", F.explode("tokens").alias("token")).groupBy("token").agg(F.min("k1").alias("k1"), F.max("k1").alias("last"))
    # a class's shingles lie in every partition: fewer, larger tasks add up more of them before the shuffle
    context = rows.sparkSession
    tasks = max(context.sparkContext.defaultParallelism, int(context.conf.get("spark.sql.shuffle.partitions")) // 8)
    own = owners.filter("k1 = last").select("k1").coalesce(tasks).groupBy("k1").agg(F.count(F.lit(1)).alias("own"))
    spare = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100))
    left = rows.filter("n > 0").select("k1", "k2", "n").distinct().join(own, "k1", "left").filter(F.coalesce("own", F.lit(0)) <= spare)
    return stage(left.select(F.monotonically_increasing_id().alias("cid"), "k1", "k2", "n"), "possible-classes")


def bitmap(classes: DataFrame) -> np.ndarray:
    """Which of some bits a class's digest may hit: a preselection of fixed size for the second reading."""
    count = classes.count()
    bits = BITMAP_BITS[0]
    while bits < min(16 * count, BITMAP_BITS[1]):
        bits *= 2
    hits = classes.select(F.explode(F.array(F.pmod("k1", F.lit(bits)), F.pmod("k2", F.lit(bits)))).alias("bit"))
    words = hits.groupBy(F.expr("bit div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(bit % 64)))").alias("on"))
    out = np.zeros(bits // 64, np.int64)
    got = words.toArrow()  # at most BITMAP_BITS[1] / 64 rows
    out[got.column("word").to_numpy()] = got.column("on").to_numpy()
    return out.view(np.uint64)


def sets_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``(cid, n, tokens)`` of every class of ``classes``."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(classes))

    def run(batches):
        on, seen = shared.value, set()
        bits = len(on) * 64
        for _, sets in _sets_of(batches):
            k1s, k2s, tokens = [], [], []
            for s in sets:
                k1, k2 = digest(s)
                hit = all(int(on[k % bits // 64]) >> (k % bits % 64) & 1 for k in (k1, k2))
                if hit and not _seen_before((k1, k2), seen):
                    k1s.append(k1)
                    k2s.append(k2)
                    tokens.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(k1s, pa.int64()), pa.array(k2s, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))],
                                             names=["k1", "k2", "tokens"])

    read = docs.select(text_or_empty().alias("text")).mapInArrow(run, "k1 bigint, k2 bigint, tokens array<bigint>")
    return stage(read.join(classes, ["k1", "k2"]).groupBy("cid", "n").agg(F.first("tokens").alias("tokens")), "class-sets")


def prefixes(sets: DataFrame, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """``(ord, token, cid)``: the prefix shingles that more than one class has, under each order."""
    tokens = sets.select("cid", "n", F.explode("tokens").alias("token"))
    common = stage(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "common-shingles")
    # single shingles come first under every order, so they only use up the prefix
    counted = tokens.join(common, "token").groupBy("cid", "n").agg(F.collect_list(F.struct("df", "token")).alias("c"))

    def run(batches):
        for batch in batches:
            out = {"ord": [], "token": [], "cid": []}
            cids, ns = batch.column("cid").to_pylist(), batch.column("n").to_pylist()
            lists = batch.column("c")
            for i, (cid, n) in enumerate(zip(cids, ns)):
                flat = lists[i].values
                df, token = flat.field("df").to_numpy(zero_copy_only=False), flat.field("token").to_numpy(zero_copy_only=False)
                room = n - least_overlap(n, percent) + 1 - (n - len(token))
                if room <= 0:
                    continue
                for o in range(orders):
                    chosen = token[np.lexsort((mix64(token.view(np.uint64) + np.uint64(o)), df))[:room]]
                    out["ord"].append(np.full(len(chosen), o, np.int32))
                    out["token"].append(chosen)
                    out["cid"].append(np.full(len(chosen), cid, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out[k]) if out[k] else np.zeros(0, t)) for k, t in (("ord", np.int32), ("token", np.int64), ("cid", np.int64))], names=list(out))

    return counted.mapInArrow(run, "ord int, token bigint, cid bigint")


def groups(found: DataFrame, orders: int = ORDERS) -> DataFrame:
    """``(cid, g1, g2)``: classes that may be linked under every order have equal groups."""
    held = stage(found, "prefixes")
    heads = held.groupBy("ord", "token").agg(F.min("cid").alias("head"), F.max("cid").alias("other")).filter("head < other").drop("other")
    node = lambda c: F.col(c) * orders + F.col("ord")  # noqa: E731  a class once for each order
    chained = held.join(stage(heads, "prefix-heads"), ["ord", "token"]).filter("cid <> head")
    labels = components(chained.select(node("head").alias("a"), node("cid").alias("b")))
    by_order = labels.select(F.expr(f"node div {orders}").alias("cid"), (F.col("node") % orders).alias("ord"), "label")
    # a class without partner under one order has none
    return (by_order.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("ord", "label"))).alias("l")).filter(F.size("l") == orders)
            .select("cid", F.xxhash64("l").alias("g1"), F.xxhash64(F.lit(1), "l").alias("g2")))


def forest(cids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT, orders: int = ORDERS) -> list[tuple[int, int]]:
    """What the links among some sets connect, as pairs of a component's smallest and each other member."""
    n = np.array([len(s) for s in sets])
    order = np.lexsort((cids, n))
    cids, sets, n = cids[order], [sets[i] for i in order], n[order]
    flat = np.concatenate(sets)
    tokens, dense, df = np.unique(flat, return_inverse=True, return_counts=True)
    starts = np.cumsum(n) - n
    own = [dense[a:a + m] for a, m in zip(starts.tolist(), n.tolist())]
    post: list[dict[int, list[int]]] = [{} for _ in range(orders)]
    place = [np.lexsort((mix64(tokens + np.uint64(o)), df)).argsort() for o in range(orders)]  # of each shingle under each order
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    # the prefixes of the sets so far, by order and shingle; a shingle of one set finds nothing
    heads, posts, filled = [], [], []
    for o in range(orders):
        own_heads = []
        for i, t in enumerate(own):
            first = t[np.argsort(place[o][t], kind="stable")[:int(n[i]) - least_overlap(int(n[i]), percent) + 1]]
            own_heads.append(first[df[first] > 1])
        sizes = np.bincount(np.concatenate(own_heads), minlength=len(tokens))
        heads.append(own_heads)
        posts.append((np.zeros(int(sizes.sum()), np.int64), (np.cumsum(sizes) - sizes).tolist()))
        filled.append([0] * len(tokens))
    mark = np.zeros(len(tokens), bool)
    for i in range(len(sets)):
        partners = np.ones(i, bool)
        for o in range(orders):
            mine = np.zeros(i, bool)
            (flat, at), count = posts[o], filled[o]
            for t in heads[o][i].tolist():
                if count[t]:
                    mine[flat[at[t]:at[t] + count[t]]] = True
                flat[at[t] + count[t]] = i
                count[t] += 1
            partners &= mine
        partners &= 100 * n[:i] >= percent * n[i]
        mark[own[i]] = True
        for j in np.flatnonzero(partners)[::-1].tolist():  # the nearest sizes first
            if find(i) != find(j):
                both = int(mark[own[j]].sum())
                if 100 * both >= percent * (int(n[i]) + int(n[j]) - both):
                    root[find(i)] = find(j)
        mark[own[i]] = False
    least: dict[int, int] = {}
    for i, c in enumerate(cids.tolist()):
        least[find(i)] = min(c, least.get(find(i), c))
    return [(least[find(i)], c) for i, c in enumerate(cids.tolist()) if least[find(i)] != c]


def group_links(cids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """Every link among some sets, as ``(smaller cid, larger cid, shingles in common)``.

    Shingles that many sets have are counted by matrix products, the others pair by
    pair from their lists; ``LINK_ROWS`` sets at a time meet all others.
    """
    n = np.array([len(s) for s in sets])
    tokens, dense, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), n)
    common, rare = df > OFTEN, (df > 1) & (df <= OFTEN)
    column = np.cumsum(common) - 1
    held = common[dense]
    order = np.argsort(column[dense[held]], kind="stable")
    row_of, column_of = owner[held][order], column[dense[held]][order]

    @lru_cache(maxsize=1)
    def matrix(chunk: int) -> np.ndarray:
        """Which sets have each of a number of common shingles."""
        a, b = np.searchsorted(column_of, (chunk * COLUMNS, (chunk + 1) * COLUMNS))
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[row_of[a:b], column_of[a:b] - chunk * COLUMNS] = 1
        return has

    held = rare[dense]
    order = np.argsort(dense[held], kind="stable")
    posted = owner[held][order]
    bounds = np.concatenate([[0], np.cumsum(df[rare])])
    pairs = [(posted[a:b][:, None].repeat(b - a, 1), posted[a:b][None].repeat(b - a, 0)) for a, b in zip(bounds, bounds[1:])]
    left = np.concatenate([x.ravel() for x, _ in pairs]) if pairs else np.zeros(0, np.int64)
    right = np.concatenate([y.ravel() for _, y in pairs]) if pairs else np.zeros(0, np.int64)
    by_left = np.argsort(left, kind="stable")
    left, right = left[by_left], right[by_left]
    out = []
    for start in range(0, len(sets), LINK_ROWS):
        stop = min(start + LINK_ROWS, len(sets))
        both = np.zeros((stop - start, len(sets)), np.int64)
        for chunk in range(-(-int(common.sum()) // COLUMNS)):
            has = matrix(chunk)
            both += np.rint(has[start:stop] @ has.T).astype(np.int64)
        a, b = np.searchsorted(left, (start, stop))
        np.add.at(both, (left[a:b] - start, right[a:b]), 1)
        i, j = np.nonzero(100 * both >= percent * (n[start:stop, None] + n[None] - both))
        smaller = cids[i + start] < cids[j]
        out += zip(cids[i + start][smaller].tolist(), cids[j][smaller].tolist(), both[i, j][smaller].tolist())
    return out


def _dealt(sets: DataFrame, grouped: DataFrame) -> DataFrame:
    """``(bin, piece, cid, tokens)``: what is to be compared together, in bins of about a task's work."""
    sizes = (sets.select("cid", "n").join(grouped, "cid").groupBy("g1", "g2")
             .agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("classes")).filter("classes > 1"))
    members = sets.join(grouped, "cid").join(sizes, ["g1", "g2"])
    blocks = F.greatest(F.lit(1), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    total = sizes.agg(F.sum("shingles")).first()[0] or 0
    bins = int(max(1, min(1 << 20, total // BLOCK_SHINGLES * 2 + 24)))
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("x"), F.greatest(k, F.col("block")).alias("y")))
    # small groups share a task by hash; each pair of a large group's blocks is a task's work of its own
    return (members.withColumn("blocks", blocks).withColumn("block", block).withColumn("p", F.explode(pair))
            .filter("blocks = 1 OR p.x < p.y")
            .withColumn("bin", F.when(F.col("blocks") == 1, F.pmod("g1", F.lit(bins)))
                        .otherwise(F.xxhash64("g1", "g2", "p.x", "p.y").bitwiseOR(F.lit(1 << 62))))
            .select("bin", F.hash("g1", "g2", "p.x", "p.y").alias("piece"), "cid", "tokens"))


def _by_piece(made, columns: list[str]):
    """What ``made(cids, sets)`` finds in each piece of a bin."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, piece in frame.groupby("piece"):
            if len(piece) > 1:
                out += made(piece["cid"].to_numpy(), [np.asarray(t, np.int64).view(np.uint64) for t in piece["tokens"]])
        return pd.DataFrame(out, columns=columns, dtype="int64")
    return run


def verified_links(sets: DataFrame, grouped: DataFrame, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """``(a, b)``: pairs that connect exactly what all links connect."""
    return _dealt(sets, grouped).groupBy("bin").applyInPandas(
        _by_piece(lambda cids, own: forest(cids, own, percent, orders), ["a", "b"]), "a bigint, b bigint")


def all_links(sets: DataFrame, grouped: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(a, b, overlap)``: every link between two classes, once."""
    return _dealt(sets, grouped).groupBy("bin").applyInPandas(  # pairs of one block meet in several tasks
        _by_piece(lambda cids, own: group_links(cids, own, percent), ["a", "b", "overlap"]), "a bigint, b bigint, overlap bigint").distinct()


@free_names
def links(docs: DataFrame, percent: int = PERCENT, orders: int = ORDERS) -> tuple[DataFrame, DataFrame]:
    """Every link, as ``(a_id, b_id, a_size, b_size, overlap)`` between representatives of different
    sets, and the membership ``(ROW, doc_id, rep_id, n_shingles, n_links)`` of every row with words.

    A set's representative is its smallest id; rows of one set are linked to each other.
    ``n_links`` counts the other rows that a row is linked with, copies included, so it is
    the row's degree without a pair per copy.  Rows grow with the links between
    different sets, which is why ``join`` does not go through them.
    """
    rows = stage(described(docs), "shingle-sets")
    classes = possible(docs, rows, percent)
    sets = sets_of(docs, classes)
    found = stage(all_links(sets, groups(prefixes(sets, percent, orders), orders), percent), "all-links")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id")).alias("first")
    named = stage(rows.filter("n > 0").groupBy("k1", "k2", "n").agg(first, F.count(F.lit(1)).alias("copies")).join(classes.select("cid", "k1", "k2"), ["k1", "k2"], "left"),
                  "classes")
    known = named.filter("cid IS NOT NULL").select("cid", F.col("first.doc_id").alias("id"), "n", "copies")
    side = lambda c, as_: known.select(F.col("cid").alias(c), F.col("id").alias(f"{as_}_id"), F.col("n").alias(f"{as_}_size"))
    pairs = found.join(side("a", "a"), "a").join(side("b", "b"), "b").select("a_id", "b_id", "a_size", "b_size", "overlap")
    ways = found.select("a", "b").unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = ways.join(known.select(F.col("cid").alias("b"), "copies"), "b").groupBy(F.col("a").alias("cid")).agg(F.sum("copies").alias("others"))
    counted = named.join(degree, "cid", "left").select("k1", "k2", F.col("first.doc_id").alias("rep_id"),
                                                       (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"))
    members = rows.filter("n > 0").join(counted.hint("merge"), ["k1", "k2"]).select(ROW, "doc_id", "rep_id", F.col("n").alias("n_shingles"), "n_links")
    return pairs, members


@free_names
def join(docs: DataFrame, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """``(ROW, doc_id, n_shingles, component_id, kept)`` of every row of ``docs``; ``kept``
    marks one row of each component: its smallest id, and of that the first row."""
    rows = stage(described(docs), "shingle-sets")
    classes = possible(docs, rows, percent)
    sets = sets_of(docs, classes)
    links = stage(verified_links(sets, groups(prefixes(sets, percent, orders), orders), percent, orders), "links")
    labels = components(links)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW))
    ids = rows.filter("n > 0").groupBy("k1", "k2").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
    linked = classes.join(labels, F.col("cid") == F.col("node")).select("k1", "k2", "label")
    known = stage(ids.join(linked, ["k1", "k2"], "left").filter("copies > 1 OR label IS NOT NULL"), "linked-classes")
    over = known.filter("label IS NOT NULL").groupBy("label").agg(F.min("first").alias("over"))
    named = stage(known.join(over, "label", "left").select("k1", "k2", F.coalesce("over", "first").alias("first")), "named-classes")
    made = rows.withColumn("own", F.when(F.col("n") > 0, F.lit(True))).join(named.withColumn("own", F.lit(True)), ["own", "k1", "k2"], "left")
    alone = F.col("first").isNull()
    return made.select(ROW, "doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
                       (alone | (F.col(f"first.{ROW}") == F.col(ROW))).alias("kept"))


@free_names
def one_of_each(docs: DataFrame, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """The rows of ``docs`` of which one stands for each component."""
    docs = as_files(docs)
    return rows_of(docs, join(docs, percent, orders).filter("kept"))
