"""N-gram Jaccard self-join by vertical partitioning.

Documents become sets of hashed five-word shingles; equal sets form one class, and classes are joined.

1. The global order of n-grams is cut into fragments (ranges of hash values). A fragment's task sees every posting of
   its n-grams, so it knows their document frequency and drops n-grams of one class. Its partial counts are summed per
   class: a class in which fewer than 80 % of the n-grams are shared can't link and is dropped.
2. The rest are ordered by frequency, rarest first. Two sets that link share an n-gram of their prefixes; classes that
   do form clusters (star edges to the smallest class of a posting, then connected components).
3. Inside clusters, partial overlaps are counted fragment by fragment and summed per pair. All pairs are counted in
   small clusters. A large cluster is first counted against its pivot, the class whose n-grams are the most common,
   which finds most components early; then all its classes are counted against all others of like size. Large clusters
   are salted over tasks in blocks of members and probes; a block goes through the fragments, sums the partial overlaps
   per pair and stops where the rest can't make a link. The number of links of each probe and the links that join
   components leave a block; the pairs themselves don't.

Every link counts at every cluster size: n_links of `similar` is exact. `one_of_each` needs the components only, so there
just the classes that the pivot does not reach are counted against the others.

Hash values are 64 bits: two shingles or sets with equal values count as equal.

Defined cases: null or wordless texts have an empty set and link with nothing; a text of fewer than five words is one
shingle; repeated rows and equal sets are one class; null doc_ids are kept; an empty table gives no rows; further
columns are ignored by `similar` and kept by `one_of_each`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stage, width
from .shingles import shingled
from .words import joined, trimmed

PERCENT = 80
#: Documents per fragment of the order, about, and the most fragments.
DOCS_PER_FRAGMENT, FRAGMENTS = 3000, 1 << 20
#: Partitions of a shuffle by fragment, at most; beyond, a partition has several fragments, one after the other.
PARTITIONS = 20_000
#: Shingles that a map task holds before it sends them.
BLOCK = 500_000
#: Clusters up to this size have all their pairs counted; larger ones are counted against pivots.
SMALL = 48
#: Fragments in which overlaps are counted; members, and probes, of a large cluster per task.
VERTICAL, SALT = 4, 500
#: Up to so many keys (16 bytes each) are broadcast.
BROADCAST_ROWS = 1_000_000
_LAST = (1 << 63) - 1


def _class_of(h: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(h.tobytes()), np.uint64).view(np.int64))


_FRAGMENTS = "frag int, kind int, cls binary, n binary, k binary, grams binary"


def _fragments(docs: DataFrame, count: int) -> DataFrame:
    """Kind 0: the classes of a block in a fragment, arrays as bytes; k grams of each lie in it. Kind 1: the documents of
    a batch, with classes, sizes of sets, hashes of texts, and ids followed by marks of those that are not null."""
    bounds = np.array([(i << 64) // count for i in range(1, count)], np.uint64)
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]

    def rows_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in _FRAGMENTS.split(", ")])

    def sent(cls, sets):
        grams = np.concatenate(sets)
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        frag = np.searchsorted(bounds, grams, "right")
        order = np.argsort(frag, kind="stable")
        frag, grams, owner = frag[order], grams[order], owner[order]
        ids = np.array(cls, np.int64)
        cuts = np.flatnonzero(np.r_[True, frag[1:] != frag[:-1], True])
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            who, k = np.unique(owner[a:b], return_counts=True)
            rows.append((int(frag[a]), 0, ids[who].tobytes(), sizes[who].astype(np.int32).tobytes(), k.astype(np.int32).tobytes(), grams[a:b].tobytes()))
        return rows_of(rows)

    def run(batches):
        done: set[int] = set()  # classes already sent by this task
        cls, sets, held = [], [], 0
        for turn, batch in enumerate(joined(batches)):
            all_cls, all_n = [], []
            for h in shingled(batch.column(2)):
                c = _class_of(h)
                all_cls.append(c)
                all_n.append(len(h))
                if not len(h) or c in done:
                    continue
                if len(done) < 1_000_000:
                    done.add(c)
                cls.append(c)
                sets.append(h)
                held += len(h)
                if held >= BLOCK:
                    yield sent(cls, sets)
                    cls, sets, held = [], [], 0
            if all_cls:
                ids, there = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                hashes = batch.column(1).to_numpy()
                yield rows_of([((all_cls[0] + turn) % count, 1, np.array(all_cls, np.int64).tobytes(), np.array(all_n, np.int32).tobytes(), hashes.tobytes(), ids.tobytes() + there.tobytes())])
        if sets:
            yield sent(cls, sets)

    return docs.select("doc_id", F.xxhash64("text").alias("hash"), "text").mapInArrow(trimmed(run), _FRAGMENTS)


def _arrays(parts: list[tuple], kinds: tuple) -> list[np.ndarray]:
    return [np.concatenate([np.frombuffer(p[i], t) for p in parts]) if parts else np.zeros(0, t) for i, t in enumerate(kinds)]


def _groups(batches, key: int = 1):
    """Consecutive rows with equal first `key` columns: (key, rows of the other columns)."""
    held, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:key] != held:
                if rows:
                    yield held, rows
                held, rows = row[:key], []
            rows.append(row[key:])
    if rows:
        yield held, rows


def _shared(fragments: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, kind, cls, n, k, grams, often): n-grams of two classes or more, dealt by class; often is log2 of the
    frequency. Rows of documents (kind 1) pass."""

    def rows_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), pa.int32(), *[pa.binary()] * 5], strict=True)], names=["bucket", "kind", "cls", "n", "k", "grams", "often"]
        )

    def run(batches):
        for (frag,), found in _groups(batches):
            for x in found:
                if x[0]:
                    yield rows_of([(frag % buckets, *x, b"")])
            parts = [x[1:] for x in found if not x[0]]
            if not parts:
                continue
            cls, n, k, grams = _arrays(parts, (np.int64, np.int32, np.int32, np.uint64))
            found.clear()  # the rows' bytes, which the arrays have copied
            parts.clear()
            ids, first = np.unique(cls, return_index=True)  # a class that two tasks sent counts once
            once = np.zeros(len(cls), bool)
            once[first] = True
            owner = np.repeat(np.searchsorted(ids, cls), k)
            grams, owner = grams[np.repeat(once, k)], owner[np.repeat(once, k)]
            n = n[first]
            order = np.argsort(grams)
            g = grams[order]
            del grams
            new = np.r_[True, g[1:] != g[:-1]]
            df = np.diff(np.r_[np.flatnonzero(new), len(g)])
            often = np.repeat(np.ceil(np.log2(df)).astype(np.uint8), df)  # 0: of one class only
            keep = often > 0
            g, o, often = g[keep], owner[order[keep]], often[keep]
            del order, owner, new, keep, df
            if not len(g):
                continue
            place = (ids[o].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((o, place))
            g, o, often, place = g[order], o[order], often[order], place[order]
            cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True])
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                who, m = np.unique(o[a:b], return_counts=True)
                rows.append((int(place[a]), 0, ids[who].tobytes(), n[who].tobytes(), m.astype(np.int32).tobytes(), g[a:b].tobytes(), often[a:b].tobytes()))
            yield rows_of(rows)

    return fragments.mapInArrow(trimmed(run), "bucket int, kind int, cls binary, n binary, k binary, grams binary, often binary")


def _survivors(shared: DataFrame) -> DataFrame:
    """Rows (cls, n, score, grams, prefix): classes of which enough n-grams are shared, how common these are on average,
    and the shared ones of the prefix. With null grams, one row for each document: doc_id, hash, n and cls."""

    def run(batches):
        for _, found in _groups(batches):
            for kind, cls, n, hashes, ids, _ in found:
                if kind:
                    m = len(cls) // 8
                    id_, there = np.frombuffer(ids, np.int64, m), np.frombuffer(ids, np.uint8, m, 8 * m)
                    none = [pa.nulls(m, t) for t in (pa.float64(), pa.binary(), pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(cls, np.int64)), pa.array(np.frombuffer(n, np.int32).astype(np.int64)), *none, pa.array(id_, mask=there == 0), pa.array(np.frombuffer(hashes, np.int64))], names=names)
            parts = [x[1:] for x in found if not x[0]]
            if not parts:
                continue
            cls, n, k, grams, often = _arrays(parts, (np.int64, np.int32, np.int32, np.uint64, np.uint8))
            ids, inv = np.unique(cls, return_inverse=True)
            total = np.zeros(len(ids), np.int64)
            np.add.at(total, inv, k)
            size = np.zeros(len(ids), np.int64)
            size[inv] = n
            good = 100 * total >= PERCENT * size
            owner = np.repeat(inv, k)
            score = np.bincount(owner, weights=often, minlength=len(ids)) / np.maximum(size, 1)
            mask = good[owner]
            grams, often, owner = grams[mask], often[mask], owner[mask]
            order = np.lexsort((grams, often, owner))
            grams, owner = grams[order], owner[order]
            who = np.flatnonzero(good)
            at = np.searchsorted(owner, np.r_[who, len(ids)])
            rows = []
            for i, c in enumerate(who):
                mine = grams[at[i] : at[i + 1]]
                least = -(-PERCENT * int(size[c]) // 100)
                prefix = mine[: max(0, len(mine) - least + 1)]  # those of one class come first in the order, and match none
                rows.append((int(ids[c]), int(size[c]), float(score[c]), np.sort(mine).tobytes(), prefix.view(np.int64)))
                if len(rows) == 2000:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    def batch_of(rows):
        cls, n, score, grams, prefix = zip(*rows, strict=True)
        none = [pa.nulls(len(rows), pa.int64())] * 2
        return pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(n, pa.int64()), pa.array(score, pa.float64()), pa.array(grams, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), *none], names=names)

    names = ["cls", "n", "score", "grams", "prefix", "doc_id", "hash"]
    return shared.mapInArrow(trimmed(run), "cls long, n long, score double, grams binary, prefix array<long>, doc_id long, hash long")


def _overlaps(members: DataFrame, partitions: int) -> DataFrame:
    """Rows (a, b, na, nb, o): pairs of a cluster that link, with overlaps summed over vertical fragments.

    members: cluster, cls, n, grams, in clusters of at most SMALL classes.
    """

    def cut(batches):
        bounds = np.array([(i << 64) // VERTICAL for i in range(VERTICAL)], np.uint64)
        for batch in batches:
            rows = []
            for cluster, cls, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                g = np.frombuffer(raw, np.uint64)
                at = [*np.searchsorted(g, bounds).tolist(), len(g)]
                rows += [(v, cluster, cls, n, g[at[v] : at[v + 1]].tobytes()) for v in range(VERTICAL) if at[v] < at[v + 1]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), *[pa.int64()] * 3, pa.binary()], strict=True)], names=["v", "cluster", "cls", "n", "grams"])

    def count(batches):
        held, size = [], 0
        for _, rows in _groups(batches, 2):
            held.append(rows)
            size += sum(len(r[-1]) for r in rows)
            if size > 500_000:
                yield counted(held)
                held, size = [], 0
        if held:
            yield counted(held)

    def counted(groups):
        rows = [r for g in groups for r in g]
        cls, n, raw = zip(*rows, strict=True)
        cls, n = np.array(cls, np.int64), np.array(n, np.int64)
        grams = np.frombuffer(b"".join(raw), np.uint64)
        row = np.repeat(np.arange(len(rows)), [len(r) // 8 for r in raw])
        group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])[row]
        order = np.lexsort((row, grams, group))
        grams, row, group = grams[order], row[order], group[order]
        new = np.r_[True, (grams[1:] != grams[:-1]) | (group[1:] != group[:-1])]
        start = np.flatnonzero(new)[np.cumsum(new) - 1]
        place = np.arange(len(row)) - start
        codes, todo, j = [], np.arange(len(row)), 0
        while len(todo := todo[place[todo] > j]):  # each n-gram with the j-th of its posting, j before it
            codes.append(row[start[todo] + j] * len(rows) + row[todo])
            j += 1
        codes, o = np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        p, m = codes // len(rows), codes % len(rows)
        swap = cls[p] > cls[m]
        a, b = np.where(swap, m, p), np.where(swap, p, m)
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (cls[a], cls[b], n[a], n[b], o)], names=["a", "b", "na", "nb", "o"])

    cutted = members.select("cluster", "cls", "n", "grams").mapInArrow(trimmed(cut), "v int, cluster long, cls long, n long, grams binary")
    dealt = cutted.repartition(partitions, "v", "cluster").sortWithinPartitions("v", "cluster").select("v", "cluster", "cls", "n", "grams")
    parts = dealt.mapInArrow(trimmed(count), "a long, b long, na long, nb long, o long")
    whole = parts.groupBy("a", "b").agg(F.min("na").alias("na"), F.min("nb").alias("nb"), F.sum("o").alias("o"))
    return whole.where(100 * F.col("o") >= PERCENT * (F.col("na") + F.col("nb") - F.col("o")))


def _joined(members: DataFrame, probes: DataFrame, partitions: int, hint) -> DataFrame:
    """Rows (a, b, k): links between probes and members of their cluster that join components, with null k; and for each
    probe a and block of members the number k of its links, with null b. A probe meets each member once.

    Both: cluster, cls, n, comp, grams. Sizes that link lie in the same band or in neighbouring ones.
    """
    band = F.floor(F.log("n") / F.log(F.lit(1.26))).cast("int")  # 1.26 > 100 / PERCENT
    members, probes = members.withColumn("band", band), probes.withColumn("band", band)
    bands = hint(members.groupBy("cluster", "band").agg(F.ceil(F.count(F.lit(1)) / SALT).cast("int").alias("salts")))
    blocks = hint(probes.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / SALT).cast("int").alias("blocks")))
    cols = ["cluster", "band", "salt", "block", "kind", "cls", "n", "comp", "grams"]
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    m = members.join(bands, ["cluster", "band"]).join(blocks, "cluster")
    m = m.withColumn("salt", F.pmod(F.xxhash64("cls"), F.col("salts")).cast("int")).withColumn("kind", F.lit(0)).withColumn("block", spread("blocks"))
    p = probes.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))).join(bands, ["cluster", "band"]).join(blocks, "cluster")
    p = p.withColumn("block", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("blocks")).cast("int")).withColumn("kind", F.lit(1)).withColumn("salt", spread("salts"))

    bounds = np.array([(i << 64) // VERTICAL for i in range(1, VERTICAL)], np.uint64)

    def run(batches):
        for _, rows in _groups(batches, 4):
            mine, ask = [r for r in rows if not r[0]], [r for r in rows if r[0]]
            if not mine or not ask:
                continue
            cls, n, comps = (np.array([r[i] for r in mine], np.int64) for i in (1, 2, 3))
            every = np.frombuffer(b"".join(r[4] for r in mine), np.uint64)
            whose = np.repeat(np.arange(len(mine)), [len(r[4]) // 8 for r in mine])
            part = np.searchsorted(bounds, every, "right")
            fragments, rest = [], np.bincount(whose, minlength=len(mine))
            for v in range(VERTICAL):
                grams, owner = every[part == v], whose[part == v]
                rest = rest - np.bincount(owner, minlength=len(mine))  # of each member, beyond this fragment
                order = np.argsort(grams, kind="stable")
                grams, owner = grams[order], owner[order]
                at = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.zeros(0, np.int64)
                fragments.append((grams[at], at, np.r_[at[1:], len(grams)], owner, rest))
            up: dict[int, int] = {}

            def find(x: int) -> int:
                while (y := up.setdefault(x, x)) != x:  # noqa: B023
                    x = y
                return x

            out = []
            for _, c, size, comp, raw in sorted(ask):
                g = np.frombuffer(raw, np.uint64)  # sorted
                cut = [0, *np.searchsorted(g, bounds).tolist(), len(g)]
                o, need = np.zeros(len(mine), np.int64), PERCENT * (size + n)
                for v, (values, at, ends, owner, rest) in enumerate(fragments):
                    mine_here = g[cut[v] : cut[v + 1]]
                    k = np.searchsorted(values, mine_here)
                    k = k[(k < len(values)) & (values[np.minimum(k, len(values) - 1)] == mine_here)] if len(values) else k[:0]
                    lengths = ends[k] - at[k]
                    flat = np.repeat(at[k] - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
                    o += np.bincount(owner[flat], minlength=len(mine))
                    if not ((100 + PERCENT) * (o + np.minimum(rest, len(g) - cut[v + 1])) >= need).any():
                        break  # no member can link any more
                found = np.flatnonzero(((100 + PERCENT) * o >= need) & (cls != c))
                if not len(found):
                    continue
                out.append((c, None, len(found)))
                # of the members that link, one of each component
                for y, i in zip(*(v.tolist() for v in np.unique(comps[found], return_index=True)), strict=True):
                    x, y = find(comp), find(y)
                    if x != y:
                        up[max(x, y)] = min(x, y)
                        out.append((c, int(cls[found[i]]), None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b", "k"])

    key = ["cluster", "band", "salt", "block"]
    dealt = m.select(*cols).union(p.select(*cols)).repartition(partitions, *key).sortWithinPartitions(*key)
    return dealt.mapInArrow(trimmed(run), "a long, b long, k long")


def class_links(docs: DataFrame, counted: bool = False) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Links (a, b) between classes, enough to join every component; (cls, n_links) of each class that links, if counted;
    and the documents: doc_id, hash of the text, n and cls, size and digest of the set of shingles."""
    spark = docs.sparkSession
    parts = width(spark)
    count = max(1, min(FRAGMENTS, docs.count() // DOCS_PER_FRAGMENT))
    frags = _fragments(docs, count).repartition(max(parts, min(count, PARTITIONS)), "frag").sortWithinPartitions("frag")
    buckets = max(parts, count // 2)
    shared = _shared(frags, buckets).repartition(max(parts, min(buckets, PARTITIONS)), "bucket").sortWithinPartitions("bucket")
    both = stage(_survivors(shared), "join-survivors")
    rest, base = both.where("grams is not null").drop("doc_id", "hash"), both.where("grams is null").select("doc_id", "hash", "n", "cls")

    index = rest.select(F.explode("prefix").alias("gram"), "cls")
    low = index.groupBy("gram").agg(F.min("cls").alias("m"), F.max("cls").alias("x")).where("m <> x").drop("x")
    edges = index.join(low, "gram").where("cls <> m").select(F.col("cls").alias("a"), F.col("m").alias("b")).distinct()
    near = components(edges)
    sizes = near.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    state = near.join(sizes, "root").select(F.col("node").alias("cls"), F.col("root").alias("cluster"), "m").join(rest.drop("prefix"), "cls")
    state = stage(state, "join-clusters")
    links = stage(_overlaps(state.where(F.col("m") <= SMALL), parts).select("a", "b"), "join-links")
    ends = links.select(F.explode(F.array("a", "b")).alias("cls"), F.lit(1).cast("long").alias("k"))

    large = state.where(F.col("m") > SMALL).withColumn("comp", F.col("cls"))
    clusters = large.select("cluster").distinct().count()
    if clusters:
        hint = F.broadcast if clusters <= BROADCAST_ROWS // 100 else lambda x: x  # some rows for each cluster
        pivot = hint(large.groupBy("cluster").agg(F.max(F.struct("score", "cls")).alias("w")).select("cluster", F.col("w.cls").alias("pivot")))
        large = large.join(pivot, "cluster")
        first = stage(_joined(large, large.where("cls = pivot"), parts, hint), "join-links").where("b is not null").select("a", "b")
        comps = components(first).select(F.col("node").alias("cls"), F.col("root").alias("found"))
        large = large.join(comps, "cls", "left").withColumn("comp", F.coalesce("found", "cls"))
        large = stage(large.drop("found"), "join-large")
        main = hint(large.where("cls = pivot").select("cluster", F.col("comp").alias("main")))
        probes = large if counted else large.join(main, "cluster").where("comp <> main")
        rest = stage(_joined(large, probes, parts, hint), "join-links")
        links = links.union(first).union(rest.where("b is not null").select("a", "b"))
        ends = ends.union(rest.where("b is null").select(F.col("a").alias("cls"), "k"))
    return links, stage(ends.groupBy("cls").agg(F.sum("k").alias("n_links")), "join-counts") if counted else None, base


def _placed(docs: DataFrame, counted: bool = False) -> DataFrame:
    """Rows (doc_id, hash, n, cls, keeper struct<id, hash>): keeper is the component's first document, null if n is 0;
    and n_links of the class, if counted."""
    links, counts, base = class_links(docs, counted)
    roots = components(links)
    row = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), "hash")
    first = base.where("n > 0").groupBy("cls").agg(F.min(row).alias("first"))
    named = first.join(roots, first["cls"] == roots["node"], "left").select("cls", "first", F.coalesce("root", "cls").alias("root"))
    lowest = named.groupBy("root").agg(F.min("first").alias("keeper"))
    named = named.join(lowest, "root").select("cls", "keeper")
    if counts is not None:
        named = named.join(counts, "cls", "left")
    return base.join(named, "cls", "left").withColumn("keeper", F.when(F.col("n") > 0, F.col("keeper")))


def similar(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links), class_id, and n_links,
    the number of other classes that its class links with."""
    keeper = F.when(F.col("keeper.id") < _LAST, F.col("keeper.id"))
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(keeper).alias("component_id")
    return _placed(docs, counted=True).select("doc_id", F.col("n").alias("n_shingles"), component, F.col("cls").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The first document of each component (by doc_id, then the text's hash), with the columns of docs."""
    found = stage(_placed(docs.select("doc_id", "text")), "join-placed")
    row = [F.coalesce("doc_id", F.lit(_LAST)).alias("__id"), F.col("hash").alias("__hash")]
    gone = found.where((F.col("keeper.id") != F.coalesce("doc_id", F.lit(_LAST))) | (F.col("keeper.hash") != F.col("hash"))).select(*row).distinct()
    twice = found.where("n > 0").groupBy(*row).count().where("count > 1").select("__id", "__hash")
    gone, twice = stage(gone, "join-gone"), stage(twice, "join-twice")
    packed = docs.select(F.struct("*").alias("__row"), F.coalesce("doc_id", F.lit(_LAST)).alias("__id"), F.xxhash64("text").alias("__hash"))
    key = ["__id", "__hash"]
    kept = packed.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, key, "left_anti")
    if not twice.isEmpty():  # rows that repeat a kept row whole in id and text
        small = F.broadcast(twice) if twice.count() <= BROADCAST_ROWS else twice
        kept = kept.join(small, key, "left_anti").union(kept.join(small, key, "left_semi").dropDuplicates(key))
    return kept.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
