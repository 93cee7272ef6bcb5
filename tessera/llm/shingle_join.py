"""N-gram Jaccard join: a size-aware heavy-light join over word shingles.

Sets are ordered by a global order: shingles by how many texts hold them
(rare first, from counts of all shingles over all texts), then by hash. Two sets with Jaccard
similarity >= t share ceil(t * n) shingles of the larger, hence at least k of the
first n - ceil(t * n) + k shingles of each.

* Small sets enumerate all 2-subsets of that prefix; two small sets are a
  candidate pair when they share a subset.
* Large sets scan the inverted lists of their prefix (k = 1). Small sets that are
  large enough to match a large one stand in those lists too.

The boundary is chosen by cost: the largest size for which enumerating subsets
is no dearer than scanning lists of the measured mean length.

Equal sets are one set. Lists of at most ``SHORT`` sets give their pairs. Longer
lists (boiler plate, large groups of near copies) give the pairs of two leaders with
every member; after verification, sets that are still apart in some list are
compared again with other leaders. What is then left in different components of a
list is set against each other in blocks, by exact sizes, by the places of the
list's element (were it the first they share, what can still be common) and by
parity sketches, which bound from below what only one of two sets has. These
bounds refuse no true pair and leave little more than the links: only what passes
becomes a row and is verified. So every link between components is found, and pairs
inside a component that cannot change the result are not listed. Candidates pass
the sketches first and are then verified on the whole sets.

What is broadcast is bounded: the frequent shingles (``MAX_FREQUENT``; the
frequency they start at rises with the corpus) and, if their number allows, the
ids of the texts that are verified; otherwise these are joined by a shuffle.

Defined results: null, empty and blank texts have no shingles and link with
nothing; repeated ids and rows keep their rows; a null id counts as larger than
all others and is no component id unless nothing else is there.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.llm.common import batch_column, given_back, positional, text_slices
from tessera.llm.graph import components
from tessera.llm.shingles import mix, set_id, shingle_sets
from tessera.session import scratch_path

SHORT = 8                    # sets of a list whose pairs are all candidates
MAX_FREQUENT = 1 << 21       # shingles kept as frequent (8 bytes each)
MAX_BROADCAST_IDS = 1 << 20  # ids of texts sent to every executor, at most
FEW_PAIRS = 200_000          # pairs between components that are listed without another round
FLUSH = 1_000_000            # hashes gathered in a task before they are written
SLICE = 4 << 20
SALTS = 16                   # tasks that the members of a list are dealt to
BLOCK = 4096                 # members of a list that are set against as many others in one task
STAR_ROUNDS = 0              # rounds with other leaders before the rest is set against each other, at most
SKETCH = 512                 # bits of a set's parity sketch


def needed(n, percent: int):
    """Shingles a set of n shares with any partner, at least."""
    return -(-n * percent // 100)


def range_bits(spark) -> int:
    """Ranges of hashes: four for each shuffle partition."""
    return max(4, math.ceil(math.log2(4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))


def size_code(n: np.ndarray) -> np.ndarray:
    """Sizes on a scale of 2 % steps."""
    return np.floor(np.log(n) / math.log(1.02)).astype(np.uint16)


def _blobs(value: np.ndarray, rest: int, extra=None):
    """Split hashes (already shifted to range and 32 bits) by range; yields
    (range, bytes) with the 32-bit keys, sorted, and the extra columns."""
    order = np.argsort(value, kind="stable")
    value = value[order]
    cols = [(value & np.uint64(0xFFFFFFFF)).astype("<u4"), *[x[order] for x in extra or ()]]
    ranges = (value >> np.uint64(32)).astype(np.int64)
    cut = np.flatnonzero(np.diff(ranges, prepend=-1))
    for a, b in zip(cut, [*cut[1:], len(value)]):
        yield int(ranges[a]), b"".join(c[a:b].tobytes() for c in cols)


def _trimmed(run):
    return lambda batches: given_back(run(batches))


def _count_map(bits: int, length: int):
    """Rows of the texts, and all their shingles by range (twice ``1 << bits`` of them)."""
    shift = np.uint64(31 - bits)

    def run(batches):
        hashes, held = [], 0
        row = TaskContext.get().partitionId() * 7919          # rows of a task go to all ranges in turn

        def counted():
            v = np.concatenate(hashes) >> shift
            part = list(_blobs(v, 0))
            return pa.RecordBatch.from_pydict({
                "range": pa.array([r for r, _ in part], pa.int32()), "doc_id": pa.nulls(len(part), pa.int64()),
                "th": pa.nulls(len(part), pa.int64()), "n": pa.nulls(len(part), pa.int64()),
                "sig": pa.nulls(len(part), pa.int64()), "blob": pa.array([b for _, b in part], pa.binary())})

        for batch in batches:
            ids, text, th = (batch_column(batch, c) for c in ("doc_id", "text", "th"))
            for a, b in text_slices(text, SLICE):
                sets = shingle_sets(text.slice(a, b - a), length)
                sig = [set_id(h) if len(h) else None for h in sets]
                yield pa.RecordBatch.from_pydict({
                    "range": pa.array((row + np.arange(b - a)) % (2 << bits), pa.int32()),
                    "doc_id": ids.slice(a, b - a), "th": th.slice(a, b - a),
                    "n": pa.array([len(h) for h in sets], pa.int64()), "sig": pa.array(sig, pa.int64()),
                    "blob": pa.nulls(b - a, pa.binary())})
                row += b - a
                for k in {x: k for k, x in enumerate(sig) if x is not None}.values():
                    hashes.append(sets[k])
                    held += len(sets[k])
                if held > FLUSH:
                    yield counted()
                    hashes, held = [], 0
        if held:
            yield counted()
    return run


def _count_reduce(t: pa.Table) -> pa.Table:
    """Doc rows pass; the keys of a range are counted and reported by class
    (power of two of the count)."""
    blob = t["blob"]
    docs = t.filter(pa.compute.is_null(blob))
    keys = b"".join(b for b in blob.to_pylist() if b is not None)
    none = pa.nulls(len(docs), pa.int64())
    out = [pa.table({"doc_id": docs["doc_id"], "th": docs["th"], "n": docs["n"], "sig": docs["sig"],
                     "class": none.cast(pa.int32()), "keys": none, "uses": none, "squares": none,
                     "blob": pa.nulls(len(docs), pa.binary())})]
    if keys:
        v, c = np.unique(np.frombuffer(keys, dtype="<u4"), return_counts=True)
        cls = np.floor(np.log2(c)).astype(np.int64)
        base = t["range"][0].as_py() << 32
        found = []
        for k in np.unique(cls):
            at = cls == k
            full = (v[at].astype(np.int64) + base).tobytes() if k >= 3 else None
            found.append((int(k), int(at.sum()), int(c[at].sum()), int((c[at] ** 2).sum()), full))
        n = len(found)
        out.append(pa.table({"doc_id": pa.nulls(n, pa.int64()), "th": pa.nulls(n, pa.int64()),
                             "n": pa.nulls(n, pa.int64()), "sig": pa.nulls(n, pa.int64()),
                             "class": pa.array([f[0] for f in found], pa.int32()),
                             "keys": pa.array([f[1] for f in found], pa.int64()),
                             "uses": pa.array([f[2] for f in found], pa.int64()),
                             "squares": pa.array([f[3] for f in found], pa.int64()),
                             "blob": pa.array([f[4] for f in found], pa.binary())}))
    return pa.concat_tables(out)


class GlobalOrder:
    """Frequency classes of the frequent shingles; all others are class 0."""

    def __init__(self, keys: np.ndarray, classes: np.ndarray, bits: int):
        self.keys, self.classes, self.shift = keys, classes, np.uint64(31 - bits)
        self.flag = np.zeros(1 << 22, dtype=bool)
        self.flag[keys & (len(self.flag) - 1)] = True

    def of(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), dtype=np.uint8)
        if not len(self.keys):
            return out
        v = (h >> self.shift).astype(np.int64)
        at = np.flatnonzero(self.flag[v & (len(self.flag) - 1)])
        place = np.minimum(np.searchsorted(self.keys, v[at]), len(self.keys) - 1)
        hit = self.keys[place] == v[at]
        out[at[hit]] = self.classes[place[hit]]
        return out

    def prefix(self, h: np.ndarray, size: int):
        """The first ``size`` of the sorted hashes in the global order, with classes."""
        part = h[:min(len(h), 2 * size)]
        cls = self.of(part)
        if len(part) < len(h) and (cls == 0).sum() < size:
            part, cls = h, self.of(h)
        order = np.argsort(cls, kind="stable")[:size]
        return part[order], cls[order]


def _posting_map(order, bits: int, length: int, percent: int, border: int):
    """Postings (element, set, size) of every text, by range of the element."""
    shift = np.uint64(32 - bits)
    lower = border + 1          # a small set meets a large one from this size on
    small_in_lists = needed(lower, percent)

    def run(batches):
        place = order.value
        e, s, n, places, held = [], [], [], [], 0

        def flush():
            el, pos = np.concatenate(e), np.concatenate(places)
            sig = np.repeat(np.array(s, dtype=np.int64), n)
            size = np.repeat(size_code(np.array([x for x in sizes], dtype=np.float64)), n)
            # frequent elements go to a range of their own set: no long list in one task
            spread = np.where(el & np.uint64(2), mix(el ^ sig.view(np.uint64)), el)
            frequent = (el & np.uint64(2)).astype(bool)
            out = []
            for flag in (False, True):
                at = np.flatnonzero(frequent == flag)
                if not len(at):
                    continue
                if flag:
                    extra = (el[at].astype("<u8"), sig[at].astype("<i8"), size[at].astype("<u2"), pos[at])
                else:
                    extra = (sig[at].astype("<i8"), size[at].astype("<u2"), pos[at])
                out += [(r, flag, b) for r, b in _blobs(spread[at] >> shift, 0, extra)]
            return pa.RecordBatch.from_pydict({
                "range": pa.array([x[0] for x in out], pa.int32()), "frequent": pa.array([x[1] for x in out]),
                "blob": pa.array([x[2] for x in out], pa.binary())})

        sizes = []
        for batch in batches:
            text = batch_column(batch, "text")
            for a, b in text_slices(text, SLICE):
                seen = set()
                for h in shingle_sets(text.slice(a, b - a), length):
                    if len(h) < 2:
                        continue                            # equal sets only, found by identity
                    sig = set_id(h)
                    if sig in seen:
                        continue
                    seen.add(sig)
                    c = needed(len(h), percent)
                    found, where = [], []
                    if len(h) <= border:
                        p, cls = place.prefix(h, len(h) - c + 2)
                        i, j = np.triu_indices(len(p), 1)
                        x, y = np.minimum(p[i], p[j]), np.maximum(p[i], p[j])
                        el = mix(mix(x) * np.uint64(3) + y) & ~np.uint64(3)
                        found.append(np.where(np.minimum(cls[i], cls[j]) > 0, el | np.uint64(2), el))
                        where.append(j - 1)
                    if len(h) >= small_in_lists:
                        p, cls = place.prefix(h, len(h) - c + 1)
                        el = (mix(p ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & ~np.uint64(3)) | np.uint64(1)
                        found.append(np.where(cls > 0, el | np.uint64(2), el))
                        where.append(np.arange(len(p)))
                    if found:
                        el = np.concatenate(found)
                        e.append(el)
                        places.append(np.minimum(np.concatenate(where), 65535).astype("<u2"))
                        s.append(sig)
                        n.append(len(el))
                        sizes.append(len(h))
                        held += len(el)
                if held > FLUSH // 2:
                    yield flush()
                    e, s, n, places, sizes, held = [], [], [], [], [], 0
        if held:
            yield flush()
    return run


def _may_match(za, pa, zb, pb, percent: int, least=np.minimum, power=np.power):
    """Whether two sets of a list may reach the similarity if this element is the
    first they share: at most n - place shingles are common then. From sizes as
    2 % codes, rounded so that no true pair is refused at its first element."""
    most = least(power(1.02, za + 1.0) - pa, power(1.02, zb + 1.0) - pb) + 0.01
    return most >= (power(1.02, za + 0.0) + power(1.02, zb + 0.0)) * (percent / (100.0 + percent))


def _posting_reduce(percent: int):
    def run(t: pa.Table) -> pa.Table:
        keys, sets, sizes, places, long = [], [], [], [], []
        for flag, blob in zip(t["frequent"].to_pylist(), t["blob"].to_pylist()):
            if flag:
                m = len(blob) // 24
                el = np.frombuffer(blob, "<u8", m, 4 * m)
                long.append((el, np.frombuffer(blob, "<i8", m, 12 * m), np.frombuffer(blob, "<u2", m, 20 * m),
                             np.frombuffer(blob, "<u2", m, 22 * m)))
            else:
                m = len(blob) // 16
                keys.append(np.frombuffer(blob, "<u4", m))
                sets.append(np.frombuffer(blob, "<i8", m, 4 * m))
                sizes.append(np.frombuffer(blob, "<u2", m, 12 * m))
                places.append(np.frombuffer(blob, "<u2", m, 14 * m))
        base = np.int64(t["range"][0].as_py()) << np.int64(32)
        x, y, n, w = ([np.empty(0, np.int64)] for _ in range(4))
        px, py = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if keys:
            k, s, z, p = np.concatenate(keys), np.concatenate(sets), np.concatenate(sizes), np.concatenate(places)
            o = np.lexsort((s, k))
            k, s, z, p = k[o], s[o], z[o], p[o]
            fresh = np.ones(len(k), dtype=bool)
            fresh[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
            k, s, z, p = k[fresh], s[fresh], z[fresh].astype(np.int64), p[fresh].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            length = np.diff(np.append(first, len(k)))
            of = np.repeat(length, length)
            in_long = of > SHORT
            x.append(k[in_long].astype(np.int64) + base)
            y.append(s[in_long])
            n.append(z[in_long])
            w.append(p[in_long])
            at = np.flatnonzero((of > 1) & ~in_long)
            for step in range(1, SHORT):                    # pairs at this distance in a short list
                i = at[at + step < len(k)]
                i = i[k[i] == k[i + step]]
                ok = _may_match(z[i], p[i], z[i + step], p[i + step], percent)
                px.append(s[i[ok]])
                py.append(s[i[ok] + step])
        for el, s, z, p in long:
            x.append(el.view(np.int64))
            y.append(s)
            n.append(z.astype(np.int64))
            w.append(p.astype(np.int64))
        px, py = np.concatenate(px), np.concatenate(py)
        if len(px):
            u = np.unique(np.stack([np.minimum(px, py), np.maximum(px, py)], axis=1), axis=0)
            px, py = u[:, 0], u[:, 1]
        x, y, n, w = np.concatenate(x), np.concatenate(y), np.concatenate(n), np.concatenate(w)
        none = np.zeros(len(px), np.int64)
        return pa.table({"long": pa.array(np.arange(len(px) + len(x)) >= len(px)),
                         "x": pa.array(np.concatenate([px, x])), "y": pa.array(np.concatenate([py, y])),
                         "size": pa.array(np.concatenate([none, n]).astype(np.int32)),
                         "place": pa.array(np.concatenate([none, w]).astype(np.int32))})
    return run


def sketch(h: np.ndarray) -> np.ndarray:
    """The parity of the number of hashes that fall on each of ``SKETCH`` bits, as
    longs. Where two sketches differ, one set has a hash that the other has not."""
    odd = np.bincount((h & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


SKETCHES = [f"s{k}" for k in range(SKETCH // 64)]


def _not_far(p, q, percent: int):
    """Whether two sets may reach the similarity by their exact sizes and sketches:
    sets of n and m at that similarity have at most (n + m)(100 - percent) / (100 +
    percent) hashes that only one of them has. No true pair is refused."""
    apart = F.lit(0)
    for k in SKETCHES:
        apart = apart + F.bit_count(p(k).bitwiseXOR(q(k)))
    return ((100 * F.least(p("n"), q("n")) >= percent * F.greatest(p("n"), q("n")))
            & (apart * (100 + percent) <= (p("n") + q("n")) * (100 - percent)))


def _fits(p, q, percent: int):
    """``_may_match`` with exact sizes and places, and the sketches."""
    most = F.least(p("n") - p("place"), q("n") - q("place"))
    return (most * (100 + percent) >= (p("n") + q("n")) * percent) & _not_far(p, q, percent)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids whose similarity reaches the percentage."""
    def marked(side: str) -> DataFrame:
        return sets.select(F.col("sig").alias(side), F.struct("n", *SKETCHES).alias(f"m{side}"))

    near = pairs.select("a", "b").join(marked("a"), "a").join(marked("b"), "b")
    near = near.where(_not_far(lambda c: F.col("ma")[c], lambda c: F.col("mb")[c], percent)).select("a", "b")
    both = (near.join(sets.select(F.col("sig").alias("a"), F.col("blob").alias("ha")), "a")
            .join(sets.select(F.col("sig").alias("b"), F.col("blob").alias("hb")), "b"))

    def run(batches):
        for batch in batches:
            ha, hb = batch_column(batch, "ha"), batch_column(batch, "hb")
            ok = np.zeros(len(batch), dtype=bool)
            for k in range(len(batch)):
                u = np.frombuffer(ha[k].as_buffer(), dtype=np.uint64)
                v = np.frombuffer(hb[k].as_buffer(), dtype=np.uint64)
                if 100 * min(len(u), len(v)) < percent * max(len(u), len(v)):
                    continue
                w = np.concatenate([u, v])
                w.sort(kind="stable")
                common = int((w[1:] == w[:-1]).sum())
                ok[k] = 100 * common >= percent * (len(w) - common)
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch_column(batch, "a").take(at), batch_column(batch, "b").take(at)],
                                             names=["a", "b"])

    return both.select("a", "b", "ha", "hb").mapInArrow(_trimmed(run), "a long, b long")


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
         length: int = 5) -> DataFrame:
    """Per row doc_id, n_shingles, component_id (smallest id reachable by links),
    text_hash and set_id (null without words)."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    spark = df.sparkSession
    bits = min(30, range_bits(spark))
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    src = src.withColumn("th", F.xxhash64("text"))

    def kept(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    # 1. set identity per text, and in how many texts each shingle stands
    counted = kept(
        src.mapInArrow(_trimmed(_count_map(bits, length)), "range int, doc_id long, th long, n long, sig long, blob binary")
        .groupBy("range").applyInArrow(_count_reduce, "doc_id long, th long, n long, sig long, class int, keys long, "
                                                      "uses long, squares long, blob binary"), "shingles")
    docs = counted.where("class is null").select("doc_id", "th", "n", "sig")
    classes = (counted.where("class is not null").groupBy("class")
               .agg(F.sum("keys").alias("keys"), F.sum("uses").alias("uses"), F.sum("squares").alias("squares"))
               .orderBy(F.desc("class")).collect())                  # one row per power of two
    least, total = 64, 0
    for r in classes:
        if r["class"] < 3 or total + r["keys"] > MAX_FREQUENT:
            break
        total, least = total + r["keys"], r["class"]
    heavy = counted.where((F.col("class") >= least) & F.col("blob").isNotNull()).select("class", "blob").collect() \
        if total else []                                             # MAX_FREQUENT keys at most
    keys = np.concatenate([np.frombuffer(r["blob"], np.int64) for r in heavy]) if heavy else np.empty(0, np.int64)
    cls = np.concatenate([np.full(len(r["blob"]) // 8, r["class"], np.uint8) for r in heavy]) if heavy \
        else np.empty(0, np.uint8)
    o = np.argsort(keys)
    order = spark.sparkContext.broadcast(GlobalOrder(keys[o], cls[o], bits))

    # 2. the boundary by cost: subsets of a small set against lists of a large one
    light = [r for r in classes if r["class"] < least]
    mean = sum(r["squares"] for r in light) / max(1, sum(r["uses"] for r in light))
    border = 1
    while border < 200:
        m = border + 1
        p = m - needed(m, percent)
        if (p + 2) * (p + 1) / 2 > (p + 1) * (1 + mean):
            break
        border = m

    # 3. postings and the candidates of their lists
    found = kept(
        src.select("text").mapInArrow(_trimmed(_posting_map(order, bits, length, percent, border)),
                                      "range int, frequent boolean, blob binary")
        .groupBy("range").applyInArrow(_posting_reduce(percent), "long boolean, x long, y long, size int, place int"), "lists")
    order.unpersist()
    lists = kept(found.where("long").select("x", F.col("y").alias("set"), "size", "place").distinct(), "long")

    steps = math.ceil(math.log(100 / percent) / math.log(1.02)) + 1      # sizes that can match

    def salted(rows: DataFrame, every: bool = False) -> DataFrame:
        """With the salt of a member, or once for every salt: no list in one task."""
        return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))) if every else
                               F.pmod(F.xxhash64("set"), F.lit(SALTS)).cast("int"))

    def stars(members: DataFrame, turn: int) -> DataFrame:
        """Pairs of two leaders of each list with its members in other components."""
        def lead(k):
            # at first the same leaders for all lists, so few pairs; later others in each list
            by = F.xxhash64("set", F.lit(k)) if turn == 0 else F.xxhash64("set", "x", F.lit(k))
            return F.min(F.struct(by.alias("r"), "set", "size", "component"))

        first = lead(2 * turn)
        if turn == 0:
            # the member with the smallest share of shingles before the list's own links with most others
            share = F.round(F.col("place") / F.pow(F.lit(1.02), F.col("size")), 2)
            first = F.min(F.struct(share.alias("s"), F.xxhash64("set").alias("r"), "set", "size", "component"))
            first = F.struct(first["r"].alias("r"), first["set"].alias("set"), first["size"].alias("size"),
                             first["component"].alias("component"))
        leads = members.groupBy("x").agg(F.array(first, lead(2 * turn + 1)).alias("leads"))
        both = salted(members).join(salted(leads, True), ["x", "salt"])
        both = both.select("set", "size", "component", F.explode("leads").alias("lead"))
        both = both.where((F.col("lead.component") != F.col("component"))
                          & (F.abs(F.col("lead.size") - F.col("size")) <= F.lit(steps)))
        return both.select(F.least("lead.set", "set").alias("a"), F.greatest("lead.set", "set").alias("b")).distinct()

    single = lists.withColumn("component", F.col("set"))
    pairs = kept(found.where(~F.col("long")).select(F.col("x").alias("a"), F.col("y").alias("b"))
                 .unionByName(stars(single, 0)).distinct(), "pairs")     # leaders of lists, pairs of short ones

    # 4. whole sets of the texts that stand in a candidate pair or a long list
    per = kept(docs.where("n > 0").groupBy("sig").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("one")), "sets")
    per = per.select("sig", F.col("one.doc_id").alias("doc_id"), F.col("one.th").alias("th"))
    involved = (pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig")))
                .union(lists.select(F.col("set").alias("sig"))).distinct())
    wanted = kept(per.join(involved, "sig", "left_semi").select(F.col("doc_id").alias("want"), "th"), "wanted")
    few = wanted.count() <= MAX_BROADCAST_IDS
    texts = src.join(F.broadcast(wanted) if few else wanted,
                     (src["th"] == wanted["th"]) & src["doc_id"].eqNullSafe(wanted["want"]), "left_semi")
    texts = texts.select("th", "text").dropDuplicates(["th"]).select("text")

    def whole(batches):
        for batch in batches:
            text = batch_column(batch, "text")
            for a, b in text_slices(text, SLICE):
                sets = [h for h in shingle_sets(text.slice(a, b - a), length) if len(h)]
                marks = np.array([sketch(h) for h in sets], dtype=np.int64).reshape(len(sets), len(SKETCHES))
                yield pa.RecordBatch.from_pydict({
                    "sig": pa.array([set_id(h) for h in sets], pa.int64()),
                    "n": pa.array([len(h) for h in sets], pa.int64()),
                    **{k: pa.array(marks[:, i]) for i, k in enumerate(SKETCHES)},
                    "blob": pa.array([h.tobytes() for h in sets], pa.binary())})

    sets = kept(texts.mapInArrow(_trimmed(whole), f"sig long, n long, {', '.join(f'{k} long' for k in SKETCHES)}, blob binary"),
                "whole")
    links = kept(_verify(pairs, sets, percent), "links")
    comp = kept(components(links), "components")

    # 5. lists whose members are still in different components
    tested, turn = pairs, 0
    while True:
        turn += 1
        members = lists.join(comp.select(F.col("node").alias("set"), "component"), "set", "left")
        members = members.withColumn("component", F.coalesce("component", "set"))
        apart = members.groupBy("x", "component").agg(F.count(F.lit(1)).alias("m"))
        apart = apart.groupBy("x").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("s"),
                                       F.count(F.lit(1)).alias("c")).where("c > 1")
        seen = Observation()
        apart = kept(apart.observe(seen, F.sum((F.col("m") * F.col("m") - F.col("s")) / 2).alias("pairs"),
                                   F.sum("m").alias("sets")), "apart")
        left = seen.get
        if not left["pairs"]:
            break
        members = salted(members).join(salted(apart.select("x", "m"), True), ["x", "salt"]).drop("salt")
        last = turn > STAR_ROUNDS or left["pairs"] <= max(4 * left["sets"], FEW_PAIRS)
        if last:
            members = members.join(sets.select(F.col("sig").alias("set"), "n", *SKETCHES), "set")
            # a long list is cut into blocks, and each pair of blocks is a group of its own
            blocks = F.ceil(F.col("m") / F.lit(BLOCK))
            members = members.withColumn("own", F.pmod(F.xxhash64("set", F.lit(1)), blocks))
            other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
            p = members.withColumn("i", F.col("own")).withColumn("j", other).alias("p")
            q = members.withColumn("j", F.col("own")).withColumn("i", other).alias("q")
            near = _fits(lambda c: F.col(f"p.{c}"), lambda c: F.col(f"q.{c}"), percent)
            same = (F.col("p.x") == F.col("q.x")) & (F.col("p.i") == F.col("q.i")) & (F.col("p.j") == F.col("q.j"))
            more = p.join(q, same & (F.col("p.component") < F.col("q.component")) & near)
            more = more.select(F.least("p.set", "q.set").alias("a"), F.greatest("p.set", "q.set").alias("b")).distinct()
        else:
            more = stars(members, turn)
        more = kept(more.join(tested, ["a", "b"], "left_anti"), "pairs")
        fresh = kept(_verify(more, sets, percent), "links")
        if not fresh.isEmpty():
            links = links.unionByName(fresh)
            comp = kept(components(links), "components")
        if last:
            break
        tested = tested.unionByName(more)

    # 6. the smallest id of each component
    per = per.join(comp.select(F.col("node").alias("sig"), "component"), "sig", "left")
    per = per.withColumn("component", F.coalesce("component", "sig"))
    smallest = per.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    per = per.join(smallest, "component").select("sig", "component_id")
    return docs.join(per, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("th").alias("text_hash"), F.col("sig").alias("set_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
             length: int = 5) -> DataFrame:
    """The rows of ``df``, all columns, of which one of each group of linked texts
    stays: the one with the smallest id. Texts without words all stay."""
    plain, names = positional(df)
    id_col, text_col = names[id_col], names[text_col]
    joined = join(plain, id_col, text_col, percent, length).where("n_shingles > 0")
    # texts with a null id only form a group by their set
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("set "), F.col("set_id")))
    one = joined.groupBy(group.alias("g")).agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("k"))
    one = one.select(F.col("k.doc_id").alias("keep_id"), F.col("k.text_hash").alias("keep_text"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    worded = text.rlike(r"[^\x20\x09-\x0D]")
    full = plain.where(worded).withColumn("own_text", F.xxhash64(F.col(text_col).cast("string")))
    full = full.withColumn("own_id", F.col(id_col).cast("long"))
    full = full.join(one, (F.col("own_text") == F.col("keep_text")) & F.col("own_id").eqNullSafe(F.col("keep_id")),
                     "left_semi").dropDuplicates(["own_text", "own_id"]).drop("own_text", "own_id")
    return full.unionByName(plain.where(~worded)).toDF(*names)
