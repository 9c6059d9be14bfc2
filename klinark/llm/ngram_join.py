"""N-gram Jaccard join by prefix trees, reduced to its connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klinark.llm.shared import bounded_groups, components, shingle_sets, slices, small_batches, whole_groups
from klinark.session import stage

HEAVY_GRAMS = 1 << 18       # most frequent n-grams that are placed last, by frequency (size of a broadcast)
COUNTED_AT_ONCE = 1_000_000  # n-grams a task counts in memory
GROUP_ROWS = 4096           # members of a frequent n-gram that meet in one block
GROUP_GRAMS = 4_000_000     # n-grams of the sets that meet in one tree
FILTER_BITS = 25            # log2 of the bits that spare moving texts without a partner
VISITS = 2                   # rounds in which a class visits only its fullest meeting
BATCH_ROWS = 1000            # rows of an Arrow batch
SKETCH_WORDS = 1 << 20       # 64-bit words of sketches compared at once
FIRST_NODE = 16             # n-grams in a node at the root; doubled on each level


def needed_overlap(a, b, percent: int):
    """Common n-grams that sets of sizes a and b need to link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """Leading n-grams of a set, one of which any linked set shares."""
    return n - -(-percent * n // 100) + 1


# --- pass 1: size, identity and sketch of each set, frequent n-grams ------------------------

def sketch(grams: np.ndarray) -> bytes:
    """Parities of the n-grams by bucket of their hash, one to two buckets per n-gram.

    Two sets that differ in d n-grams have sketches that differ in at most d bits, whatever
    they have in common. The halves of a sketch, combined by exclusive or, are the sketch of half the length.
    """
    bits = 64
    while bits < len(grams):
        bits *= 2
    counts = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _describe(size: int, keyed: bool):
    fields = [("doc_id", pa.int64()), ("row_key", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()),
              ("sketch", pa.binary()), ("gram", pa.int64()), ("hits", pa.int64())]
    fields += [("text_key", pa.binary())] if keyed else []
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[np.ndarray] = []
        seen: set[bytes] = set()
        held = 0

        def repeated():
            grams, hits = np.unique(np.concatenate(pending), return_counts=True)
            grams, hits = grams[hits > 1], hits[hits > 1]
            k = len(grams)
            return pa.record_batch([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                                    pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), pa.array(grams.view(np.int64)),
                                    pa.array(hits.astype(np.int64)), *([pa.nulls(k, pa.binary())] if keyed else [])],
                                   schema=schema)

        for batch in slices(batches):
            sets = shingle_sets(batch["text"], size)
            names = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            k = len(sets)
            yield pa.record_batch([batch["doc_id"], batch["row_key"], pa.array([len(s) for s in sets], pa.int64()),
                                   pa.array(names, pa.binary()),
                                   pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                                   pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                                   *([batch["text_key"].cast(pa.binary())] if keyed else [])], schema=schema)
            for s, name in zip(sets, names):
                if name is not None and name not in seen:
                    seen.add(name)
                    pending.append(s)
                    held += len(s)
                    if held >= COUNTED_AT_ONCE:
                        yield repeated()
                        pending, held, seen = [], 0, set()
        if pending:
            yield repeated()
    kind = "doc_id long, row_key long, n long, cls binary, sketch binary, gram long, hits long"
    return run, kind + (", text_key binary" if keyed else "")


def _heavy(grams: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent n-grams: sorted values, their ranks by frequency, frequency by rank.

    At most HEAVY_GRAMS come to the driver: a histogram of the frequencies on a log
    scale gives the cut. The list only fixes the global order of n-grams; any order gives
    the same links, a good one makes prefixes rare.
    """
    totals = stage(grams.groupBy("gram").agg(F.sum("hits").alias("hits"))
                   .withColumn("step", F.floor(F.log2("hits") * 8)), "ngram-frequent")
    cut, room = None, HEAVY_GRAMS
    for step, count in sorted(((r[0], r[1]) for r in totals.groupBy("step").count().collect()), reverse=True):
        if count > room:
            break
        cut, room = step, room - count
    if cut is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = totals.filter(F.col("step") >= cut).select("gram", "hits").toPandas()
    values, hits = rows["gram"].to_numpy(np.int64).view(np.uint64), rows["hits"].to_numpy(np.int64)
    by_rank = np.lexsort((values, hits))
    rank = np.empty(len(values), np.uint64)
    rank[by_rank] = np.arange(len(values), dtype=np.uint64)
    order = np.argsort(values)
    return values[order], rank[order], hits[by_rank]


def _ordered(grams: np.ndarray, heavy) -> np.ndarray:
    """Sorted keys whose numeric order is the global order of n-grams.

    Rare ones come first, by hash. A frequent one has the top bit, its rank and hash bits.
    """
    values, rank, _ = heavy
    keys = grams >> np.uint64(1)
    if len(values):
        at = np.minimum(np.searchsorted(values, grams), len(values) - 1)
        known = np.flatnonzero(values[at] == grams)
        low = grams[known] & np.uint64((1 << 43) - 1)
        keys[known] = np.uint64(1 << 63) | (rank[at[known]] << np.uint64(43)) | low
    return np.sort(keys)


def _frequency(keys: np.ndarray, heavy) -> np.ndarray:
    """Frequency of the frequent n-grams among the keys, 0 for the others."""
    hits, frequent = np.zeros(len(keys), np.int64), keys >= np.uint64(1 << 63)
    hits[frequent] = heavy[2][((keys[frequent] >> np.uint64(43)) & np.uint64((1 << 20) - 1)).astype(np.int64)]
    return hits


# --- pass 2: prefixes, and the members of each n-gram that may link ------------------------

def _prefixes(size: int, percent: int, heavy):
    schema = pa.schema([("gram", pa.int64()), ("block", pa.int64()), ("cls", pa.binary()), ("n", pa.int64()),
                        ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = heavy.value
        for batch in slices(batches):
            done: set[bytes] = set()
            grams, blocks, names, sizes, places = [], [], [], [], []
            for s in shingle_sets(batch["text"], size):
                name = xxhash.xxh3_128_digest(s.tobytes())
                if not len(s) or name in done:
                    continue
                done.add(name)
                p = prefix_length(len(s), percent)
                keys = _ordered(s, order)[:p]
                parts = -(-_frequency(keys, order) // GROUP_ROWS)
                at = np.arange(p)
                spread = parts > 1
                if spread.any():  # every pair of blocks meets
                    own = np.frombuffer(name, np.uint64)[0]
                    for k in np.flatnonzero(spread).tolist():
                        b, many = int((own ^ keys[k]) % np.uint64(parts[k])), int(parts[k])
                        other = np.arange(many)
                        grams.append(np.full(many, keys[k]))
                        blocks.append(np.minimum(b, other) * many + np.maximum(b, other))
                        places.append(np.full(many, k))
                        names += [name] * many
                        sizes.append(np.full(many, len(s)))
                    keys, at = keys[~spread], at[~spread]
                grams.append(keys)
                blocks.append(np.zeros(len(keys), np.int64))
                places.append(at)
                names += [name] * len(keys)
                sizes.append(np.full(len(keys), len(s)))
            if grams:
                yield pa.record_batch([pa.array(np.concatenate(grams).view(np.int64)),
                                       pa.array(np.concatenate(blocks)), pa.array(names, pa.binary()),
                                       pa.array(np.concatenate(sizes).astype(np.int64)),
                                       pa.array(np.concatenate(places).astype(np.int64))], schema=schema)
    return run, "gram long, block long, cls binary, n long, at long"


def _may_link(n: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """Members with another member that length and position still allow, row block by row block."""
    left = n - at
    kept = np.zeros(len(n), bool)
    for start in range(0, len(n), 512):
        rows = slice(start, start + 512)
        fits = (np.minimum(left[rows, None], left[None, :]) >= needed_overlap(n[rows, None], n[None, :], percent))
        fits &= 100 * np.minimum(n[rows, None], n[None, :]) >= percent * np.maximum(n[rows, None], n[None, :])
        fits[np.arange(fits.shape[0]), np.arange(start, start + fits.shape[0])] = False
        kept[rows] = fits.any(axis=1)
    return kept


def _groups(percent: int):
    """Meetings of the members of each n-gram and block; of a block that outgrows the limit, its members.

    The members come back with gram, block and at, for another cut; in meetings these are null.
    """
    schema = pa.schema([("grp", pa.binary()), ("cls", pa.binary()), ("n", pa.int64()), ("gram", pa.int64()),
                        ("block", pa.int64()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab, bounds in bounded_groups(batches, ["gram", "block"], 5 * GROUP_ROWS // 2):
            if bounds is None:
                yield pa.record_batch([pa.nulls(tab.num_rows, pa.binary()),
                                       *[tab[f.name].combine_chunks().cast(f.type) for f in list(schema)[1:]]], schema=schema)
                continue
            sizes, places = tab["n"].to_numpy(), tab["at"].to_numpy()
            names = tab["cls"].combine_chunks()
            out: list[tuple] = []
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if end - start < 2:
                    continue
                own = names[start:end].to_pylist()
                n, at = sizes[start:end], places[start:end]
                first = [k for k in range(len(own)) if k == 0 or own[k] != own[k - 1]]  # rows are sorted by class
                if len(first) < 2:
                    continue
                if len(first) < len(own):
                    own, n, at = [own[k] for k in first], n[first], at[first]
                kept = np.flatnonzero(_may_link(n, at, percent)).tolist()
                if kept:
                    name = xxhash.xxh3_128_digest(b"".join(own[k] for k in kept))
                    out += [(name, own[k], int(n[k])) for k in kept]
            if out:
                found = [pa.array(c, f.type) for c, f in zip(zip(*out), schema)]
                yield pa.record_batch([*found, *[pa.nulls(len(out), pa.int64())] * 3], schema=schema)
    return run, "grp binary, cls binary, n long, gram long, block long, at long"


def _meetings(prefixes: DataFrame, percent: int) -> DataFrame:
    """(grp, cls, n) of all meetings; n-grams with many members are cut into blocks of which every two meet.

    Frequent n-grams of the list come cut already. Any other n-gram with many members is read through as a
    stream, and its members, counted now, are cut in the same way; nothing depends on the list being complete.
    """
    run, kind = _groups(percent)

    def meet(members: DataFrame, label: str) -> DataFrame:
        return stage(members.repartition("gram", "block").sortWithinPartitions("gram", "block", "cls")
                     .mapInArrow(run, kind).distinct(), label)

    found = meet(prefixes, "ngram-meetings")
    meetings, level = found.filter("grp is not null"), 0
    while not found.filter("grp is null").isEmpty():
        crowded, level = found.filter("grp is null"), level + 1
        parts = (crowded.groupBy("gram", "block").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("parts")))
        own = F.pmod(F.xxhash64("cls", "gram", F.lit(level)), F.col("parts"))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
        cut = (crowded.join(parts, ["gram", "block"]).withColumn("own", own).withColumn("other", other)
               .withColumn("block", F.xxhash64("block", F.least("own", "other"), F.greatest("own", "other"))))
        found = meet(cut.select("gram", "block", "cls", "n", "at"), f"ngram-crowded-{level}")
        meetings = meetings.unionByName(found.filter("grp is not null"))
    return meetings.select("grp", "cls", "n")


# --- pass 3: sketches rule out most members ------------------------------------------------

def alike(n: np.ndarray, sketches: list[bytes], percent: int) -> np.ndarray:
    """Label of each set: sets joined by pairs whose sketches still allow a link have the same one.

    A link allows few different n-grams, and sketches differ in no more bits than sets do in n-grams,
    so two linked sets always have the same label. A longer sketch is folded to the shorter one's length,
    over as many doublings as the sizes of linked sets may be apart.
    """
    label = np.arange(len(n))
    lengths = np.array([len(x) for x in sketches])
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        bits = np.frombuffer(b"".join(sketches[k] for k in own.tolist()), np.uint64).reshape(len(own), -1)
        other, other_bits = own, bits
        longer = np.flatnonzero((lengths > length) & (percent * n <= 100 * n[own].max()))
        for size in np.unique(lengths[longer]).tolist():
            some = longer[lengths[longer] == size]
            parts = np.frombuffer(b"".join(sketches[k] for k in some.tolist()), np.uint64)
            parts = parts.reshape(len(some), size // length, -1)
            other = np.concatenate((other, some))
            other_bits = np.concatenate((other_bits, np.bitwise_xor.reduce(parts, axis=1)))
        step = max(1, SKETCH_WORDS // other_bits.size)
        for start in range(0, len(own), step):
            rows = own[start:start + step]
            differ = np.bitwise_count(bits[start:start + step, None, :] ^ other_bits[None, :, :]).sum(axis=2, dtype=np.int64)
            a, b = n[rows, None], n[None, other]
            fits = differ <= a + b - 2 * needed_overlap(a, b, percent)
            fits &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
            for k, row in enumerate(rows.tolist()):
                joined = np.unique(label[other[fits[k]]])  # holds the label of the row itself
                if len(joined) > 1:
                    label[np.isin(label, joined)] = joined[0]
    return label


def _candidates(percent: int):
    schema = pa.schema([("grp", pa.binary()), ("cls", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab, bounds in whole_groups(batches, ["grp", "block"]):
            names, sizes = tab["cls"].combine_chunks(), tab["n"].to_numpy()
            bits = tab["sketch"].combine_chunks()
            out: list[tuple] = []
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                own = names[start:end].to_pylist()
                first = [k for k in range(len(own)) if k == 0 or own[k] != own[k - 1]]  # rows are sorted by class
                own, n = [own[k] for k in first], sizes[start:end][first]
                label = alike(n, bits[start:end].take(pa.array(first)).to_pylist(), percent)
                groups: dict[int, list[int]] = {}
                for k, to in enumerate(label.tolist()):
                    groups.setdefault(to, []).append(k)
                for group in groups.values():
                    if len(group) > 1:
                        name = xxhash.xxh3_128_digest(b"".join(own[k] for k in group))
                        out += [(name, own[k], int(n[k])) for k in group]
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return run, "grp binary, cls binary, n long"


# --- pass 4: the sets meet in prefix trees -------------------------------------------------

class PrefixTree:
    """Sets of ordered keys in a compressed trie: children share the path of their parent.

    A node holds a run of keys, the range of sets below it and their smallest and largest
    size. Runs are cut at depths 16, 48, 112, ..., so an unlike set is left after a few keys.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets])
        shared = np.zeros(len(sets), np.int64)  # keys shared with the set before
        for k in range(1, len(sets)):
            m = min(len(sets[k]), len(sets[k - 1]))
            differs = np.flatnonzero(sets[k][:m] != sets[k - 1][:m])
            shared[k] = differs[0] if len(differs) else m
        runs, depth, low, high, children = [], [0], [0], [len(sets)], [[]]
        todo = [(0, len(sets), 0, 0)]
        while todo:
            lo, hi, d, parent = todo.pop()
            common = int(shared[lo + 1:hi].min()) if hi - lo > 1 else len(sets[lo])
            if common > d:
                stop = FIRST_NODE
                while stop <= d:
                    stop = 2 * stop + FIRST_NODE
                stop = min(stop, common)
                node = len(depth)
                runs.append(sets[lo][d:stop])
                depth.append(stop)
                low.append(lo)
                high.append(hi)
                children.append([])
                children[parent].append(node)
                if stop < common or hi - lo > 1:
                    todo.append((lo, hi, stop, node))
            else:  # the paths part here; a set that ends here is the first of the range
                cuts = [lo, *(np.flatnonzero(shared[lo + 1:hi] == d) + lo + 1).tolist(), hi]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if b - a > 1 or len(sets[a]) > d:
                        todo.append((a, b, d, parent))
        self.depth, self.low, self.high = np.array(depth), np.array(low), np.array(high)
        lengths = np.array([0] + [len(r) for r in runs])
        self.run_at = np.cumsum(lengths) - lengths
        self.run_len = lengths
        self.keys = np.concatenate(runs) if runs else np.zeros(0, np.uint64)
        self.least = np.array([self.size[a:b].min() for a, b in zip(low, high)])
        self.most = np.array([self.size[a:b].max() for a, b in zip(low, high)])
        self.child_at = np.cumsum([0] + [len(c) for c in children])
        self.child = np.array([x for c in children for x in c], np.int64)

    def matches(self, own: np.ndarray, open_before: np.ndarray, percent: int) -> np.ndarray:
        """Sets linked with `own`, among subtrees that hold an open set.

        `open_before[k]` counts the open sets before k. Overlaps are summed along the paths,
        once per shared run. A subtree is left as soon as the overlap so far plus the keys that
        remain on either side cannot reach the overlap its sizes need.
        """
        found = []
        nodes, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(nodes):
            counts = self.child_at[nodes + 1] - self.child_at[nodes]
            overlap = np.repeat(overlap, counts)
            ends = np.cumsum(counts)
            nodes = self.child[np.repeat(self.child_at[nodes] - ends + counts, counts) + np.arange(ends[-1])]
            live = open_before[self.high[nodes]] > open_before[self.low[nodes]]
            close = np.clip(len(own), self.least[nodes], self.most[nodes])  # the size below that suits best
            live &= 100 * np.minimum(close, len(own)) >= percent * np.maximum(close, len(own))
            nodes, overlap = nodes[live], overlap[live]
            if not len(nodes):
                break
            lengths = self.run_len[nodes]
            ends = np.cumsum(lengths)
            keys = self.keys[np.repeat(self.run_at[nodes] - ends + lengths, lengths) + np.arange(ends[-1])]
            place = np.searchsorted(own, keys)
            hit = own[np.minimum(place, len(own) - 1)] == keys
            overlap = overlap + np.add.reduceat(hit.astype(np.int64), ends - lengths)
            rest = len(own) - (place[ends - 1] + hit[ends - 1])
            reach = overlap + np.minimum(rest, self.most[nodes] - self.depth[nodes])
            ok = reach >= needed_overlap(len(own), self.least[nodes], percent)
            nodes, overlap = nodes[ok], overlap[ok]
            ended = self.depth[nodes] == self.size[self.low[nodes]]  # the first set of the range ends here
            at = self.low[nodes[ended]]
            o = overlap[ended]
            found.append(at[100 * o >= percent * (len(own) + self.size[at] - o)])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def link_components(sets: list[np.ndarray], label: np.ndarray, percent: int) -> np.ndarray:
    """Labels after merging those of linked sets; sets with one label need no comparison."""
    order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u8").tobytes())
    tree, label = PrefixTree([sets[k] for k in order]), label[order].copy()
    for k in range(len(order) - 1):
        still = label != label[k]
        still[:k + 1] = False
        if not still.any():
            continue
        for j in tree.matches(sets[order[k]], np.concatenate(([0], np.cumsum(still))), percent).tolist():
            if label[j] != label[k]:
                label[label == label[j]] = label[k]
    out = np.empty(len(order), np.int64)
    out[order] = label
    return out


def _solve(percent: int):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab, bounds in whole_groups(batches, ["grp", "block"]):
            names, grams = tab["root"].combine_chunks(), tab["grams"].combine_chunks()
            left, right = [], []
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                own = names[start:end].to_pylist()
                roots = {name: k for k, name in enumerate(dict.fromkeys(own))}
                if len(roots) < 2:
                    continue
                sets = [np.frombuffer(g, np.uint64) for g in grams[start:end].to_pylist()]
                after = link_components(sets, np.array([roots[x] for x in own]), percent)
                lead: dict[int, bytes] = {}
                for name, to in dict(zip(own, after.tolist())).items():
                    if lead.setdefault(to, name) != name:
                        left.append(name)
                        right.append(lead[to])
            if left:
                yield pa.record_batch([pa.array(left, pa.binary()), pa.array(right, pa.binary())], schema=schema)
    return run, "a binary, b binary"


def _bit(row_key: str) -> Column:
    return F.pmod(F.xxhash64(row_key), F.lit(1 << FILTER_BITS))


def _may_be_wanted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose key may be among the wanted ones; a key whose bit is unset surely is not.

    The table of bits has at most 2^(FILTER_BITS - 6) rows, whatever the input, so it is broadcast.
    """
    table = (wanted.select(_bit("row_key").alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")))
    return (rows.withColumn("bit", _bit("row_key")).withColumn("word", F.shiftright("bit", 6))
            .join(F.broadcast(table), "word").filter("shiftright(bits, cast(bit & 63 as int)) & 1 = 1")
            .select(*rows.columns))


def _sets(size: int, heavy):
    schema = pa.schema([("places", pa.list_(pa.struct([("grp", pa.binary()), ("block", pa.int64())]))),
                        ("root", pa.binary()), ("cls", pa.binary()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, sent = heavy.value, set()  # a row that is repeated very often sends its class once per task
        for batch in slices(batches):
            names = batch["cls"].to_pylist()
            new = [k for k, name in enumerate(names) if name not in sent]
            batch = batch.take(pa.array(new, pa.int64()))
            sets, names, real = shingle_sets(batch["text"], size), batch["cls"].to_pylist(), []
            for k, s in enumerate(sets):
                if names[k] not in sent and xxhash.xxh3_128_digest(s.tobytes()) == names[k]:
                    real.append(k)
                    sent.add(names[k])
            if real:
                rows = batch.take(pa.array(real))
                grams = pa.array([_ordered(sets[k], order).tobytes() for k in real], pa.binary())
                yield pa.record_batch([rows["places"].cast(schema.field("places").type), rows["root"].cast(pa.binary()),
                                       rows["cls"].cast(pa.binary()), grams], schema=schema)
    return run, "places array<struct<grp binary, block long>>, root binary, cls binary, grams binary"


def _class_roots(rows: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Described rows, classes of equal sets, and the root of each class that has a link."""
    spark = rows.sparkSession
    keyed = "text_key" in rows.columns
    run, kind = _describe(size, keyed)
    described = stage(rows.mapInArrow(run, kind), "ngram-described")
    described = described.withColumn("is_gram", F.col("gram").isNotNull())
    sets = described.filter("not is_gram").select("doc_id", "row_key", "n", "cls", *(["text_key"] if keyed else []))
    heavy = spark.sparkContext.broadcast(_heavy(described.filter("is_gram").select("gram", "hits")))

    run, kind = _prefixes(size, percent, heavy)
    prefixes = rows.select("text").mapInArrow(run, kind)
    meetings = _meetings(prefixes, percent)
    classes = sets.filter("cls is not null").groupBy("cls").agg(F.min("row_key").alias("row_key"),
                                                               F.min("doc_id").alias("doc_id"))

    def trees(members: DataFrame, label: str) -> DataFrame:
        """Pairs of roots that links merge; `members` has grp, block, cls, root."""
        places = stage(members.groupBy("cls").agg(F.min("root").alias("root"),
                                                  F.collect_list(F.struct("grp", "block")).alias("places"))
                       .join(classes.select("cls", "row_key"), "cls"), f"{label}-places")
        texts = _may_be_wanted(rows.select("row_key", "text"), places)
        run, kind = _sets(size, heavy)
        whole = (texts.join(places, "row_key").select("text", "cls", "root", "places").mapInArrow(run, kind))
        run, kind = _solve(percent)
        met = whole.select(F.explode("places").alias("p"), "root", "cls", "grams").select("p.*", "root", "cls", "grams")
        return stage(met.repartition("grp", "block").sortWithinPartitions("grp", "block", "cls")
                     .mapInArrow(run, kind), f"{label}-merged")

    def blocks(members: DataFrame) -> DataFrame:
        """Cut meetings with many n-grams into blocks; every two blocks meet."""
        parts = (members.groupBy("grp").agg(F.ceil(F.sum("n") / GROUP_GRAMS).alias("parts"))
                 .filter("parts > 1"))
        own = F.pmod(F.xxhash64("cls", "grp"), F.col("parts"))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("parts"), F.lit(1)) - 1))
        return (members.join(parts, "grp", "left").withColumn("own", F.coalesce(own, F.lit(0)))
                .withColumn("other", other)
                .withColumn("block", F.least("own", "other") * F.coalesce("parts", F.lit(1)) + F.greatest("own", "other")))

    # one row for each set of an id, however often its row is repeated
    sketches = (described.filter("not is_gram and cls is not null").groupBy("row_key", "cls")
                .agg(F.first("sketch").alias("sketch")))
    run, kind = _candidates(percent)
    candidates = stage(blocks(meetings).select("grp", "block", "cls", "n").join(classes.select("cls", "row_key"), "cls")
                       .join(sketches, ["row_key", "cls"]).select("grp", "block", "cls", "n", "sketch")
                       .repartition("grp", "block").sortWithinPartitions("grp", "block", "cls")
                       .mapInArrow(run, kind).distinct(), "ngram-candidates")

    pending, merged = candidates.select("grp", "cls", "n", F.col("cls").alias("root")), None
    for turn in range(VISITS):  # each class visits its fullest meeting
        full = pending.join(pending.groupBy("grp").agg(F.count("*").alias("members")), "grp")
        choice = full.groupBy("cls").agg(F.max_by(F.struct("grp", "n", "root"), F.struct("members", "grp")).alias("m"))
        visits = stage(blocks(choice.select("cls", "m.*")).filter("own = other")
                       .select("grp", "block", "cls", "root"), f"ngram-visits-{turn}")
        links = trees(visits, f"ngram-visit-{turn}")
        merged = links if merged is None else merged.union(links)
        roots = stage(components(merged, f"ngram-roots-{turn}"), f"ngram-roots-{turn}")
        visited = visits.select("cls", F.struct("grp", "block").alias("visit"))
        moved = (pending.drop("root").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
                 .withColumn("root", F.coalesce("root", "cls")).join(visited, "cls"))
        ends = moved.groupBy("grp").agg(F.min("root").alias("r1"), F.max("root").alias("r2"),
                                        F.min("visit").alias("v1"), F.max("visit").alias("v2"))
        unsettled = ends.filter("r1 <> r2 and v1 <> v2").select("grp")
        pending = stage(moved.drop("visit").join(unsettled, "grp", "left_semi"), f"ngram-pending-{turn}")
    rest = trees(blocks(pending).select("grp", "block", "cls", "root"), "ngram-rest")
    return sets, classes, components(merged.union(rest), "ngram-links")


def _named_sets(rows: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The set of each row of `rows` (doc_id, text[, text_key]), and (cls, doc_id, root) of each class."""
    rows = rows.withColumn("row_key", F.coalesce("doc_id", F.xxhash64("text")))
    with small_batches(rows.sparkSession, BATCH_ROWS):
        sets, classes, roots = _class_roots(rows, size, percent)
    named = classes.select("cls", "doc_id").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    return sets, named.withColumn("root", F.coalesce("root", "cls"))


def text_key(text: str = "text") -> Column:
    """128 bits that tell texts apart."""
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))


def repeated_rows(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Rows of `docs` that are no document of their own: (doc_id, text_key, gone), a row per id and text.

    Of the rows of a component that have an id, the first by (doc_id, class, text) stays, and so does the
    first of those that have none; the others are gone. An id and text that stay, or that have an id but
    no word, are listed with gone = false where several rows hold them.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets, named = _named_sets(rows.withColumn("text_key", text_key()), size, percent)
    keys = (sets.groupBy("doc_id", "text_key").agg(F.min("cls").alias("cls"), F.count("*").alias("rows"))
            .join(named.select("cls", "root"), "cls", "left").withColumn("anonymous", F.col("doc_id").isNull()))
    keys = stage(keys, "ngram-keys")
    firsts = (keys.filter("root is not null").groupBy("root", "anonymous")
              .agg(F.min(F.struct("doc_id", "cls", "text_key")).alias("first"), F.count("*").alias("members"))
              .filter("members > 1").select("root", "anonymous", "first.text_key", "first.doc_id")
              .withColumnsRenamed({"text_key": "first_text", "doc_id": "first_id"}))
    gone = F.coalesce(~(F.col("first_text").eqNullSafe(F.col("text_key")) & F.col("first_id").eqNullSafe(F.col("doc_id")))
                      & F.col("first_text").isNotNull(), F.lit(False))
    return (keys.join(firsts, ["root", "anonymous"], "left").withColumn("gone", gone)
            .filter("gone or (rows > 1 and (root is not null or not anonymous))").select("doc_id", "text_key", "gone"))


def ngram_components(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """Component of each document under "n-gram sets have Jaccard similarity >= percent / 100".

    Returns (doc_id, n_shingles, component_id): one row per row of `docs`, the size of its set
    of distinct n-grams, the smallest doc_id reachable by links, itself included.

    Equal sets form a class, found by a 128-bit digest and combined before any shuffle, so a
    group of copies of any size is one member from then on. N-grams have one global order, rare
    ones first. Two linked sets share one of their leading n-grams; classes meet by these, keep
    the meetings that length and position allow, and meetings with the same members count once.
    A short sketch of each set (`sketch`) then splits a meeting into the groups whose members may
    link; it bounds the overlap from above, so it loses no link, and it is 32 to 64 times smaller
    than the set. In these groups the whole sets meet in a prefix tree (`PrefixTree`). First each class visits its fullest
    meeting only, a few times; a meeting is settled once its members have one component or have
    all made the same visit. Then the members of the others meet, all of them. Frequent n-grams and large meetings are cut into blocks
    of which every two meet, and no link is lost. An n-gram that the bounded list of frequent ones leaves
    out is cut once its members turn out to be many (`_meetings`).

    Nulls and oddities: a null or word-less text has n_shingles 0 and links with nothing (its
    component is its own doc_id); a null doc_id is never a component's name, a component with null
    ids only has a null name; repeated rows and repeated ids each give their row, equal texts
    sharing a component. Other columns are ignored. N-grams are compared by 63-bit hashes.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets, named = _named_sets(rows, size, percent)
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "root").select("cls", "component_id")
    return (sets.join(named, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
