"""N-gram Jaccard join with set-relation skipping.

Two documents link when 100 * |A n B| >= 75 * |A u B| over their distinct 5-word shingles. The join is exact:

1. Equal sets are one node (the hash of the set); a task keeps each node once, so a group of copies of any size
   costs one set per task.
2. Spark counts the shingles; the most frequent ones (a bounded table) come last in the common order of all
   sets, so an ordinary set's prefix holds rare shingles. Links always share a shingle of both prefixes.
3. Prefix postings are dealt by shingle range into index lists. Lists are sorted by the shingle's position in
   the set and cut into blocks: a block whose best position cannot reach the overlap its sizes need is skipped
   whole (index-level skipping), others are compared entry by entry under the same bound.
4. First each set is compared only with one hub, the set with the smallest position in most of its lists (near
   copies share a hub, so a group costs links in proportion to its size). Sets already joined need no answer of their own.
   For the rest, |u n v| is bounded on both sides from the answers of u and v against their common hub
   (answer-level skipping): most pairs are accepted or dropped without reading the sets again, the others are
   compared exactly.

Defined cases: null, empty and wordless texts have an empty set, no links and, as component, their own id. Fewer
than five words: the whole sequence is the only shingle. Rows with equal ids are separate rows; a null id is
never a component's name unless the component has no other. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varsift.llm import text_arrays as ta
from varsift.llm.arrow_jobs import report
from varsift.llm.graph import components
from varsift.llm.storage import unused, written

SHINGLE = 5
#: Size of the table of frequent shingles, the bound on what is sent to the driver and the executors.
FREQUENT = 1 << 20
MIN_FREQUENT = 3
#: Shingles of one bucket, on average; the number of buckets grows with the corpus.
BUCKET = 1 << 21
BITMAP_BITS = 25
#: Pairs of one set that are compared in one task.
PARTNERS = 256
BLOCK = 512
FLUSH = 1 << 20
_SHORT = np.uint64(24)  # lists are keyed by the upper 40 bits; a mix-up only adds a candidate
_SENT = np.uint64(16)  # sets are compared by the upper 48 bits: a chance match in two of a thousand words: 4 in 10**9
_COARSE = np.uint64(32)  # counts are kept by the upper 32 bits; a mix-up only changes the common order


def linked(inter: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """100 * inter >= 75 * (a + b - inter)."""
    return 7 * inter >= 3 * (a + b)


def shingle_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, row) of every document's set, sorted by row and shingle."""
    data = ta.LOWER[data]
    start, end, row = ta.word_spans(data, at, ta.NON_SPACE)
    words = ta.span_hashes(ta.prefix_sums(data), start, end)
    full = ta.shingle_hashes(words, SHINGLE)
    inside = row[: len(full)] == row[SHINGLE - 1 :] if len(full) else np.zeros(0, bool)
    hashes, rows = [full[inside]], [row[: len(full)][inside]]
    count = ta.counts_by_row(row, len(at) - 1)
    first = np.cumsum(count) - count
    for n in range(1, SHINGLE):
        short = np.flatnonzero(count == n)
        if len(short):
            own = words[(first[short][:, None] + np.arange(n)).reshape(-1)]
            hashes.append(ta.shingle_hashes(own, n)[::n])
            rows.append(short)
    h, r = np.concatenate(hashes), np.concatenate(rows)
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(r[order], kind="stable")]
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[new], r[new]


def _nodes(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 63-bit name for each set (bounds: n + 1 offsets into h)."""
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(ta.mix(h ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
    return ta.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)) >> np.uint64(1)


def _profile():
    def score(data: np.ndarray, at: np.ndarray) -> list:
        h, row = shingle_sets(data, at)
        bounds = np.searchsorted(row, np.arange(len(at)))
        return [np.diff(bounds), ta.signed(_nodes(h, bounds))]

    return score


def _distinct_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(shingles, bounds, nodes) chunk by chunk, each non-empty set once in a task."""
    seen: set[int] = set()
    for batch in batches:
        for _, data, at in ta.chunks(batch, "_text"):
            h, row = shingle_sets(data, at)
            bounds = np.searchsorted(row, np.arange(len(at)))
            nodes = _nodes(h, bounds)
            fresh = np.zeros(len(nodes), bool)
            for k in np.flatnonzero(np.diff(bounds)).tolist():
                if (node := int(nodes[k])) not in seen:
                    seen.add(node)
                    fresh[k] = True
            size = np.diff(bounds)
            yield h[fresh.repeat(size)], np.append(0, np.cumsum(size[fresh])), nodes[fresh]


def _pack(sorted_short: np.ndarray, width: int = 5) -> bytes:
    """Sorted keys of ``width`` bytes as byte planes of their differences (the upper planes are mostly zero and compress)."""
    gaps = np.diff(sorted_short, prepend=np.uint64(0))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpack(packed: bytes, width: int = 5) -> np.ndarray:
    gaps = np.zeros((len(packed) // width, 8), np.uint8)
    gaps[:, :width] = np.frombuffer(packed, np.uint8).reshape(width, -1).T
    return np.cumsum(gaps.reshape(-1).view(np.uint64))


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(4, -1).T).reshape(-1).view(np.uint32).astype(np.int64)


def _slices(short: np.ndarray, buckets: int, bits: int) -> list[tuple[int, slice]]:
    """Non-empty ranges of sorted keys by bucket."""
    edges = np.searchsorted(short, np.array([(k << bits) // buckets for k in range(buckets + 1)], np.uint64))
    edges[-1] = len(short)
    return [(k, slice(a, b)) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]


def frequent_shingles(texts: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The (32-bit key, number of distinct sets) of the most frequent shingles, by key; at most FREQUENT."""
    buckets = min(buckets, FREQUENT)

    def count(batches):
        def flush():
            short, n = np.unique(np.concatenate(held) >> _COARSE, return_counts=True)
            for k, s in _slices(short, buckets, 32):
                more = np.flatnonzero(n[s] > 1)
                yield pa.RecordBatch.from_pylist([{"bucket": k, "keys": _pack(short[s]), "at": _planes(more),
                                                   "n": _planes(n[s][more])}], schema=counted)

        held, size = [], 0
        for h, _, _ in _distinct_sets(batches):
            held.append(h)
            size += len(h)
            if size >= 2 * FLUSH:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    counted = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("at", pa.binary()), ("n", pa.binary())])
    most = max(1, FREQUENT // buckets)

    def gather(group: pa.Table) -> pa.Table:
        keys, number = [], []
        for r in group.to_pylist():
            keys.append(_unpack(r["keys"]))
            n = np.ones(len(keys[-1]), np.int64)
            n[_unplanes(r["at"])] = _unplanes(r["n"])
            number.append(n)
        keys, number = np.concatenate(keys), np.concatenate(number)
        order = np.argsort(keys, kind="stable")
        keys, number = keys[order], number[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, number = keys[first], np.add.reduceat(number, first)
        often = np.flatnonzero(number >= MIN_FREQUENT)
        often = np.sort(often[np.lexsort((keys[often], -number[often]))[:most]])
        return pa.table({"keys": [_pack(keys[often])], "n": [_planes(np.minimum(number[often], (1 << 32) - 1))]})

    rows = (texts.mapInArrow(count, "bucket int, keys binary, at binary, n binary").groupBy("bucket")
            .applyInArrow(gather, "keys binary, n binary").collect())
    keys = np.concatenate([np.zeros(0, np.uint64), *(_unpack(bytes(r["keys"])) for r in rows)])
    number = np.concatenate([np.zeros(0, np.int64), *(_unplanes(bytes(r["n"])) for r in rows)])
    order = np.argsort(keys)
    return keys[order], number[order]


def _viable(keys: np.ndarray, size: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Entries that could pass the bound of ``_passes`` with the smallest set of their list that is large enough."""
    number = np.cumsum(np.append(0, keys[1:] != keys[:-1])) if len(keys) else keys.astype(np.int64)
    order = np.lexsort((size, number))
    wide = int(size.max()) + 1 if len(size) else 1
    rank = number[order] * wide + size[order]
    place = np.searchsorted(rank, number * wide + (3 * size + 3) // 4)
    place = place + (order[np.minimum(place, len(order) - 1)] == np.arange(len(order)))  # not itself
    place = np.minimum(place, len(order) - 1)
    partner = order[place] if len(order) else order
    return (number[partner] == number) & (partner != np.arange(len(order))) & linked(size - pos, size, size[partner])


def index_lists(texts: DataFrame, buckets: int) -> DataFrame:
    """The index lists with two sets or more: token, then entries (node, size, pos) sorted by position share."""
    often, number = frequent_shingles(texts, buckets)
    dealt = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("which", pa.binary()), ("pos", pa.binary()),
                       ("nodes", pa.binary()), ("sizes", pa.binary())])

    def postings(batches):
        def flush():
            keys, which, pos = (np.concatenate([x[k] for x in held]) for k in range(3))
            nodes, sizes = (np.concatenate([x[k] for x in held]) for k in (3, 4))
            order = np.argsort(keys, kind="stable")
            keys, which, pos = keys[order], which[order], pos[order]
            for k, s in _slices(keys, buckets, 40):
                used, own = np.unique(which[s], return_inverse=True)  # a record has only the sets that its postings name
                yield pa.RecordBatch.from_pylist([{
                    "bucket": k, "keys": _pack(keys[s]), "which": _planes(own), "pos": _planes(pos[s]),
                    "nodes": nodes[used].tobytes(), "sizes": _planes(sizes[used])}], schema=dealt)

        held, size, docs = [], 0, 0
        for h, bounds, nodes in _distinct_sets(batches):
            n = np.diff(bounds)
            row = np.arange(len(n)).repeat(n)
            weight = np.zeros(len(h), np.int64)
            if len(often):
                place = np.minimum(np.searchsorted(often, h >> _COARSE), len(often) - 1)
                weight = np.where(often[place] == h >> _COARSE, number[place], 0)
            order = np.lexsort((h, weight, row))
            pos = np.arange(len(h)) - bounds[:-1].repeat(n)
            prefix = n - (3 * n + 3) // 4 + 1
            own = pos < prefix.repeat(n)
            held.append(((h >> _SHORT)[order][own], row[own] + docs, pos[own], nodes, n))
            size, docs = size + int(own.sum()), docs + len(n)
            if size >= FLUSH:
                yield from flush()
                held, size, docs = [], 0, 0
        if size:
            yield from flush()

    def gather(group: pa.Table) -> pa.Table:
        keys, nodes, sizes, pos = [], [], [], []
        for r in group.to_pylist():
            which = _unplanes(r["which"])
            keys.append(_unpack(r["keys"]))
            nodes.append(np.frombuffer(r["nodes"], np.uint64)[which])
            sizes.append(_unplanes(r["sizes"])[which].astype(np.int32))
            pos.append(_unplanes(r["pos"]).astype(np.int32))
        keys, nodes, sizes, pos = (np.concatenate(x) for x in (keys, nodes, sizes, pos))
        order = np.argsort(keys, kind="stable")
        run = keys[order]
        often = np.zeros(len(run), bool)
        same = run[1:] == run[:-1]
        often[1:] |= same
        often[:-1] |= same
        order = order[often]
        keys, nodes, sizes, pos = keys[order], nodes[order], sizes[order], pos[order]
        order = np.lexsort((nodes, keys))
        keys, nodes, sizes, pos = keys[order], nodes[order], sizes[order], pos[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes, sizes, pos = keys[new], nodes[new], sizes[new], pos[new]
        keep = _viable(keys, sizes.astype(np.int64), pos)
        keys, nodes, sizes, pos = keys[keep], nodes[keep], sizes[keep], pos[keep]
        order = np.lexsort((nodes, -sizes.astype(np.int64), pos / np.maximum(sizes, 1), keys))
        keys, nodes, sizes, pos = keys[order], nodes[order], sizes[order], pos[order]
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[: len(keys)]
        size = np.diff(np.append(new, len(keys)))
        keep, hub = (size > 1).repeat(size), new.repeat(size)
        return pa.table({"token": keys.view(np.int64)[keep], "node": nodes.view(np.int64)[keep], "size": sizes[keep],
                         "pos": pos[keep], "hub": nodes.view(np.int64)[hub][keep], "hub_size": sizes[hub][keep],
                         "hub_pos": pos[hub][keep]})

    return (texts.mapInArrow(postings, "bucket int, keys binary, which binary, pos binary, nodes binary, sizes binary")
            .groupBy("bucket").applyInArrow(gather, "token long, node long, size int, pos int, hub long, hub_size int, hub_pos int"))


def compare(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, inter, size_a, size_b): exact overlaps of the pairs' sets.

    A bitmap of the wanted nodes (bounded: 4 MB) keeps other documents' sets from being sent at all.
    """
    slot = F.col("node").bitwiseAND((1 << BITMAP_BITS) - 1)
    wanted = (pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
              .groupBy(F.shiftright(slot, 6).alias("word"))
              .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(node & 63 as int))")).alias("bits")).toArrow())
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    bitmap[wanted["word"].to_numpy()] = wanted["bits"].to_numpy().view(np.uint64)

    def sets(batches):
        for h, bounds, nodes in _distinct_sets(batches):
            place = nodes & np.uint64((1 << BITMAP_BITS) - 1)
            want = np.flatnonzero((bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1))
            if len(want):
                short = h >> _SENT
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[want].view(np.int64)),
                     pa.array([_pack(short[bounds[k] : bounds[k + 1]], 6) for k in want.tolist()], pa.binary())], ["node", "tokens"])

    have = texts.mapInArrow(sets, "node long, tokens binary").dropDuplicates(["node"])
    # a set with very many partners is repeated under salts, so that its pairs spread over tasks
    salts = pairs.groupBy("b").agg(F.expr(f"1 + count(*) div {PARTNERS}").alias("salts"))
    salted = pairs.join(salts, "b").select("a", "b", F.pmod(F.xxhash64("a"), "salts").alias("salt"))
    targets = have.join(salts.withColumnRenamed("b", "node"), "node").select(
        F.col("node").alias("b"), F.col("tokens").alias("tb"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    sides = salted.join(have.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a").join(targets, ["b", "salt"])

    def overlap(batches):
        for batch in batches:
            a, b, ta_, tb_ = batch.columns
            inter, size_a, size_b, last, mine = [], [], [], None, None
            for x, y in zip(ta_, tb_, strict=True):
                x, y = _unpack(x.as_buffer(), 6), y.as_buffer()
                if last is None or not last.equals(y):
                    last, mine = y, _unpack(y, 6)
                place = np.searchsorted(mine, x)
                inter.append(int((mine[np.minimum(place, len(mine) - 1)] == x).sum()))
                size_a.append(len(x))
                size_b.append(len(mine))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(inter, pa.int32()), pa.array(size_a, pa.int32()),
                                              pa.array(size_b, pa.int32())], ["a", "b", "inter", "size_a", "size_b"])

    return sides.select("a", "b", "ta", "tb").mapInArrow(overlap, "a long, b long, inter int, size_a int, size_b int")


def _passes(left: np.ndarray, size: np.ndarray, other_left: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the shingles from the common one on can still give the overlap a link needs."""
    return linked(np.minimum(left, other_left), size, other)


def open_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of a list whose sets are in different components: (a, b, sure), from lists in several ones.

    ``rows``: entries with their component and, where known, their overlap with the list's hub.
    """

    def run(batches):
        def one(token):
            own = [np.concatenate(x) for x in zip(*held, strict=True)]
            node, size, pos, comp, inter, hub_size = own
            if (comp == comp[0]).all():
                return
            order = np.lexsort((node, pos / size))
            node, size, pos, comp, inter, hub_size = (x[order] for x in own)
            left = size - pos
            # best case of each block: its most remaining shingles against its smallest set
            blocks = [slice(k, k + BLOCK) for k in range(0, len(node), BLOCK)]
            best = [(int(left[s].max()), int(size[s].min())) for s in blocks]
            for i, s in enumerate(blocks):
                for j in range(i, len(blocks)):
                    t = blocks[j]
                    if 7 * min(best[i][0], best[j][0]) < 3 * (best[i][1] + best[j][1]):
                        continue  # block skip
                    ok = _passes(left[s][:, None], size[s][:, None], left[t][None], size[t][None])
                    ok &= comp[s][:, None] != comp[t][None]
                    if i == j:
                        ok &= np.arange(len(ok))[:, None] < np.arange(len(ok))[None]
                    x, y = np.nonzero(ok)
                    x, y = x + s.start, y + t.start
                    known = (inter[x] >= 0) & (inter[y] >= 0)
                    high = np.minimum(inter[x], inter[y]) + np.minimum(size[x] - inter[x], size[y] - inter[y])
                    low = inter[x] + inter[y] - hub_size[x]
                    keep = ~known | linked(high, size[x], size[y])
                    sure = known & linked(low, size[x], size[y])
                    x, y, sure = x[keep], y[keep], sure[keep]
                    if len(x):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.minimum(node[x], node[y])), pa.array(np.maximum(node[x], node[y])),
                             pa.array(sure)], ["a", "b", "sure"])

        token, held = None, []
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
            cols = [x.astype(np.int64) for x in cols]
            cuts = np.append(np.flatnonzero(np.append(True, cols[0][1:] != cols[0][:-1])), batch.num_rows)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and cols[0][a] != token:
                    yield from one(token)
                    held = []
                token = cols[0][a]
                held.append([x[a:b] for x in cols[1:]])
        if held:
            yield from one(token)

    return rows.mapInArrow(run, "a long, b long, sure boolean")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", total: int | None = None) -> DataFrame:
    """(a, b) between set nodes: enough links that their components are those of all links."""
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("_text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, -(-(total or 0) // BUCKET))
    lists = written(index_lists(texts, buckets), "lists")
    near = "7 * least(size - pos, hub_size - hub_pos) >= 3 * (size + hub_size)"
    # of each set the hub that it shares most lists with; what this leaves apart is asked below
    first = (lists.where(f"node <> hub and {near}").groupBy("node", "hub").count()
             .groupBy(F.col("node").alias("a")).agg(F.max_by("hub", F.struct("count", "hub")).alias("b")))
    answers = written(compare(texts, written(first, "pairs")), "answers")
    found = answers.where("7 * inter >= 3 * (size_a + size_b)").select("a", "b")
    comp = written(components(found), "components")
    known = answers.groupBy(F.col("a").alias("node")).agg(F.map_from_entries(F.collect_list(F.struct("b", "inter"))).alias("known"))
    state = comp.join(known, "node", "full")
    rows = lists.join(state, "node", "left").select(
        "token", "node", "size", "pos", F.coalesce("component", "node").alias("comp"),
        F.when(F.col("node") == F.col("hub"), F.col("size")).otherwise(F.coalesce(F.col("known")[F.col("hub")], F.lit(-1))).alias("inter"),
        "hub_size")
    pairs = open_pairs(rows.repartition("token").sortWithinPartitions("token"))
    pairs = written(pairs.groupBy("a", "b").agg(F.max("sure").alias("sure")), "open")
    sure = pairs.where("sure").select("a", "b")
    asked = pairs.where("not sure").select("a", "b").join(
        answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    more = compare(texts, asked).where("7 * inter >= 3 * (size_a + size_b)").select("a", "b")
    return found.unionByName(sure).unionByName(more)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, ``n_shingles``, ``component_id`` (smallest linked id)."""
    own = written(report(docs, _profile, "n_shingles long, node long", id_col, text_col), "sets")
    total = own.agg(F.sum("n_shingles")).first()[0] or 0
    comp = components(links(docs, id_col, text_col, total))
    lowest = own.where("n_shingles > 0").groupBy("node").agg(F.min(id_col).alias("low"))
    named = lowest.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    name = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(name, "component").select("node", "component_id")
    return own.join(named, "node", "left").select(
        id_col, "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(id_col)).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, all columns as they are: the one with the smallest id, named ones before null ids.

    A document is known by its id and two hashes of its text, as ids may repeat or be null; of rows that are equal in
    these, one stays. Documents without shingles are in no component and all stay.
    """
    text = F.col(text_col).cast("string")
    key = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), F.xxhash64(text).alias("h"),
                   F.xxhash64(F.lit(1), text).alias("g"))
    rows = classes(docs.select(key.alias("_key"), text.alias("_text")), "_key", "_text")
    kept = written(rows.where(F.col("_key") == F.col("component_id")).groupBy("_key")
                   .agg((F.count("*") > 1).alias("_many"), F.max("n_shingles").alias("_size")), "kept")
    many = F.col("_many") & (F.col("_size") > 0)

    i, h, g = unused(docs, "_id", "_h", "_g")

    def those(wanted: DataFrame) -> DataFrame:
        wanted = wanted.select(F.col("_key.id").alias(i), F.col("_key.h").alias(h), F.col("_key.g").alias(g))
        return docs.join(wanted, F.col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(text) == F.col(h))
                         & (F.xxhash64(F.lit(1), text) == F.col(g)), "left_semi")

    if kept.where(many).isEmpty():
        return those(kept)
    one = those(kept.where(many)).withColumns({h: F.xxhash64(text), g: F.xxhash64(F.lit(1), text)})
    one = one.dropDuplicates([id_col, h, g]).drop(h, g)
    return those(kept.where(~many)).unionByName(one)


#: The same rows in DuckDB: equal sets are one node, all pairs of nodes with a shingle in common are counted, and the
#: smallest id is handed along the links until nothing changes.
SQL = r"""
WITH RECURSIVE docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
tokens AS (SELECT r, len(words) AS n, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs),
places AS (SELECT r, n, i, concat_ws(' ', w, lead(w, 1) OVER next, lead(w, 2) OVER next, lead(w, 3) OVER next, lead(w, 4) OVER next) AS shingle
  FROM tokens WINDOW next AS (PARTITION BY r ORDER BY i)),
sets AS (SELECT r, list_sort(list(DISTINCT shingle)) AS shingles FROM places WHERE i <= greatest(n - 4, 1) GROUP BY r),
nodes AS MATERIALIZED (SELECT row_number() OVER () AS node, shingles, len(shingles) AS n FROM (SELECT DISTINCT shingles FROM sets)),
postings AS (SELECT node, n, unnest(shingles) AS shingle FROM nodes),
common AS (SELECT a.node AS u, b.node AS v, count(*) AS shared, any_value(a.n + b.n) AS total
  FROM postings a JOIN postings b ON a.shingle = b.shingle AND a.node <> b.node GROUP BY a.node, b.node),
links AS (SELECT u, v FROM common WHERE 100 * shared >= 75 * (total - shared)),
own AS (SELECT r, doc_id, node, n FROM docs JOIN sets USING (r) JOIN nodes USING (shingles)),
reach AS (SELECT node, node AS goal FROM nodes UNION SELECT reach.node, links.v FROM reach JOIN links ON reach.goal = links.u),
named AS (SELECT reach.node, min(own.doc_id) AS low FROM reach JOIN own ON own.node = reach.goal GROUP BY reach.node)
SELECT docs.doc_id, coalesce(own.n, 0) AS n_shingles, coalesce(named.low, docs.doc_id) AS component_id
FROM docs LEFT JOIN own USING (r) LEFT JOIN named ON named.node = own.node
"""
