"""SimHash near-dedup by multi-index hashing.

A fingerprint has a bit set if it is set in over half of the XXH64 hashes of the text's four-word shingles. Fingerprints
at RADIUS or fewer differing bits are linked. With s segments, two linked fingerprints differ in at most RADIUS // s bits
of some segment, so looking up the Hamming ball of that radius around each segment's value in a table keyed by segment
value finds every link; complete distances are verified. Only distinct fingerprints take part: copies meet before.

A fingerprint may have several 64-bit words (the hashes are mixed anew for each), which tells texts of lower similarity
apart from chance. With a `reach`, the radius of the balls, below the one that finds every link, a pair is found unless
all segments differ in more than `reach` bits.

drop_near_duplicates can also ask for a Jaccard similarity of the shingles. Fingerprints then stand for sets of shingles,
and the links that the tables find are only candidates: each is checked on the two texts. A node hands in its nearest
candidates, few at first; where there are more, the checked links' components are formed and the search goes on between
nodes of different components, each from where its list ended, until no list has a rest. Pairs that counts of their shingles
by class rule out take no check then. So a group of near copies of any size takes a few checks a member, no similar candidate
is missed, and no task holds a group's texts.

Table and probes are dealt by a segment's leading bits. Balls over the trailing bits are enumerated inside the task;
only flips of leading bits travel, as rows, and of two values only one to the other. A task reduces its verified links to a spanning forest before it emits them,
so that a group of near copies yields as many rows as members, not as pairs. Components come from alternating
large-star and small-star rounds on durable tables.

Cases: a null text counts as empty; a text of fewer words is one shingle, without words the fingerprint is zero and
links like any other; a null doc_id never names a component unless it is alone in it; repeated rows get a row each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import durable, give_back, join_groups, mix, partitions, pick, raw, renamed, settled

SHINGLE, SEED, RADIUS = 4, 42, 4
PROBES = 1 << 20
BITS_AT_ONCE = 1 << 16
FLIPS = 16  # most rows of a fingerprint and segment before half of them are left out
DIRECT = 22  # trailing bits up to which a table is addressed directly
WIDE, HELD = 64, 1 << 22  # entries of a key that the first round reads; candidates that a task holds before it shortens them
BROADCAST_ROWS = 1_000_000  # of two numbers
ONE_TASK = 1 << 20  # links
ROUTE_ROWS = 1 << 15  # nodes of a later round for a task
SHARE = 256  # pairs of a node that are checked together
TRIES = 4  # candidates that a node hands in at first; four times as many each round after


def shingles(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The hashes of the text's shingles, in order."""
    parts = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not parts:
        return np.empty(0, np.uint64)
    n = max(1, len(parts) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    begin = np.concatenate([[0], ends[: n - 1]]).tolist()
    end = (ends[min(shingle, len(parts)) - 1 :][:n] - 1).tolist()
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(begin, end)), np.uint64, n)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED, words: int = 1) -> list[int]:
    """The fingerprint's words; the first one is the plain fingerprint."""
    return majorities(shingles(text, shingle, seed), words)


def majorities(hashed: np.ndarray, words: int) -> list[int]:
    n, out = len(hashed), []
    if not n:
        return [0] * words
    for k in range(words):
        with np.errstate(over="ignore"):
            own = mix(hashed + np.uint64(k) * np.uint64(0x9E3779B97F4A7C15)) if k else hashed
        bits = sum(np.unpackbits(own[a : a + BITS_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64) for a in range(0, n, BITS_AT_ONCE))
        out.append(int.from_bytes(np.packbits(bits * 2 > n).tobytes(), "big"))
    return out


def columns(words: int) -> list[str]:
    return [f"w{k}" for k in range(words)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, words: int = 1, sets: bool = False) -> DataFrame:
    """doc_id, text_hash, fp, w0, w1, ... (signed longs). fp names the fingerprint: itself if of one word, else a hash of its
    words. sets: repeated shingles count once, and fp is a hash of the set."""

    def run(batches):
        for batch in batches:
            body, at = raw(batch.column("text"))
            body, found, names = body.tobytes(), [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                hashed = shingles(body[a:b], shingle, SEED)
                if sets:
                    hashed = np.unique(hashed)
                    names.append(xxhash.xxh3_64_intdigest(hashed.tobytes()))
                found.append(majorities(hashed, words))
            found = np.array(found, np.uint64).reshape(-1, words).view(np.int64)
            names = np.array(names, np.uint64).view(np.int64) if sets else np.zeros(len(batch), np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "fp": pa.array(names, pa.int64())} | {c: pa.array(found[:, k], pa.int64()) for k, c in enumerate(columns(words))})

    rows = pick(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, fp long, " + ", ".join(f"{c} long" for c in columns(words)))
    return rows if sets else rows.withColumn("fp", F.col("w0") if words == 1 else F.xxhash64(*columns(words)))


def layout(segments: int) -> list[tuple[int, int]]:
    """(shift, bits) of the segments of a word."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:])]


def ball(bits: int, radius: int) -> np.ndarray:
    """All masks of `bits` bits with at most `radius` set."""
    masks = {0}
    for _ in range(radius):
        masks |= {m | 1 << b for m in masks for b in range(bits)}
    return np.array(sorted(masks), np.uint64)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 and links a-b: each node's root, the smallest node that it reaches."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(up := root[root], root):
            root = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _deal(words: int, segments: int, lead: int, radius: int, more: tuple = ()):
    """Each fingerprint once per segment (own) and once per flip of leading bits: route, key, left (the radius that remains), fp, words, more.

    Of two leading values only one is sent to the other's route; which one, the bits that they share decide.
    """

    def run(batches):
        for batch in batches:
            own = [batch.column(c) for c in ("fp", *columns(words), *more)]
            for w, column in enumerate(own[1 : 1 + words]):
                value = column.to_numpy().view(np.uint64)
                for s, (shift, bits) in enumerate(layout(segments)):
                    part, trail, number = (value >> np.uint64(shift)) & np.uint64((1 << bits) - 1), np.uint64(bits - lead), w * segments + s
                    for mask in ball(lead, radius):
                        key = part ^ (mask << trail)
                        dealt = (key >> trail).astype(np.int64) + (number << lead), key.astype(np.int64) + (number << 40), np.full(len(batch), radius - int(mask).bit_count(), np.int32)
                        sent = pa.RecordBatch.from_arrays([*(pa.array(x) for x in dealt), *own], ["route", "key", "left", "fp", *columns(words), *more])
                        if mask:
                            head, lowest = part >> trail, np.uint64(int(mask) & -int(mask))
                            sent = sent.filter(pa.array(((head & lowest) > 0) ^ (np.bitwise_count(head & ~mask) % 2 > 0)))
                        yield sent

    return run


def lookups(route: np.ndarray, key: np.ndarray, left: np.ndarray, node: np.ndarray, words: int, segments: int, lead: int, radius: int, most: int | None = None):
    """Table lookups of one partition: arrays (a, b) of nodes that share a key within their balls, a pair once a segment.

    most: of a key's entries only so many are read; what this leaves out comes last, as (None, nodes concerned).
    """
    order, passed = np.lexsort((key, route)), []
    for rows in np.split(order, np.flatnonzero(np.diff(route[order])) + 1):
        trail = layout(segments)[(int(route[rows[0]]) >> lead) % segments][1] - lead
        tail = key[rows] & ((1 << trail) - 1)
        own = left[rows] == radius
        table, at = tail[own], rows[own]
        starts = np.searchsorted(table, np.arange((1 << trail) + 1)) if trail <= DIRECT else None
        for used in range(radius + 1):  # flips spent on leading bits
            probe = left[rows] == radius - used
            value, probe = tail[probe], node[rows[probe]]
            for mask in ball(trail, radius - used):
                wanted = value ^ np.int64(mask)
                first, last = (starts[wanted], starts[wanted + 1]) if starts is not None else (np.searchsorted(table, wanted), np.searchsorted(table, wanted, "right"))
                hit = np.flatnonzero(last > first)
                counts = (last - first)[hit]
                if most is not None and len(wide := hit[counts > most]):
                    rest = np.zeros(len(table) + 1, np.int64)
                    np.add.at(rest, first[wide] + most, 1)
                    np.add.at(rest, last[wide], -1)
                    passed += [probe[wide], node[at[np.cumsum(rest)[:-1] > 0]]]
                    counts = np.minimum(counts, most)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(counts) // PROBES)) + 1, [len(hit)]])
                for x, y in zip(cuts[:-1], cuts[1:]):
                    n = counts[x:y]
                    a = np.repeat(probe[hit[x:y]], n)
                    ends = np.cumsum(n)
                    b = node[at[np.repeat(first[hit[x:y]] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]]
                    near = (a < b) | (used > 0) & (a != b)
                    yield a[near], b[near]
    if passed:
        yield None, np.unique(np.concatenate(passed))


def _gathered(batches, names: list[str]):
    """All rows of a partition as arrays, and the distinct fp: (route, key, left, nodes, first row of each node, node of each row, others)."""
    got = [[b.column(c).to_numpy() for c in ("route", "key", "left", "fp", *names)] for b in batches if len(b)]
    if not got:
        return None
    route, key, left, fp, *value = (np.concatenate(x) for x in zip(*got))
    nodes, first, node = np.unique(fp, return_index=True, return_inverse=True)
    return route, key, left, nodes, node, [x[first] for x in value]


def differing(bits: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return sum(np.bitwise_count(x[a] ^ x[b]).astype(np.int64) for x in bits)


def _match(words: int, segments: int, lead: int, radius: int, distance: int):
    """Verified links of one partition as a spanning forest: (a, b), b the smaller fingerprint."""

    def run(batches):
        got = _gathered(batches, columns(words))
        if got is None:
            return
        route, key, left, nodes, node, value = got
        bits, root = [x.view(np.uint64) for x in value], np.arange(len(nodes))
        for a, b in lookups(route, key, left, node, words, segments, lead, radius):
            near = differing(bits, a, b) <= distance
            a, b = root[a[near]], root[b[near]]
            if (a != b).any():
                root = forest(a, b, len(nodes))[root]
        linked = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_pydict({"a": pa.array(nodes[linked], pa.int64()), "b": pa.array(nodes[root[linked]], pa.int64())})
        del got, route, key, left, nodes, node, bits, value, root, linked
        give_back()

    return run


#: A node's component, the last candidate that it handed in, its number of shingles, and how many of them fall into each of
#: LANES classes, a byte each, eight in a column.
LANES = 256
STATE = ("root", "past", "past_other", "size", *(f"h{k}" for k in range(LANES // 8)))


def lanes(hashed: np.ndarray) -> np.ndarray:
    """Counts of shingles by class; all 255 if one does not fit in a byte, which leaves overlaps unbounded."""
    counts = np.bincount((mix(hashed) >> np.uint64(56)).astype(np.int64), minlength=LANES)
    return np.minimum(counts if counts.max() < 256 else 255, np.full(LANES, 255)).astype(np.uint8)


def can_be_similar(counts: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, jaccard: float) -> np.ndarray:
    """Whether pairs can have the similarity: they have no more shingles in common than the lesser counts of each class add up to."""
    out = np.empty(len(a), bool)
    for k in range(0, len(a), 1 << 14):
        x, y = a[k : k + (1 << 14)], b[k : k + (1 << 14)]
        common = np.minimum(counts[x], counts[y]).sum(1, dtype=np.int64)
        out[k : k + len(x)] = (common * (1 + jaccard) >= jaccard * (size[x] + size[y]) - 1e-6) | (np.minimum(size[x], size[y]) >= 255 * LANES)
    return out


def _nearest(words: int, segments: int, lead: int, radius: int, distance: int, jaccard: float, most: int, first: bool):
    """Candidates of one partition: (fp, other, bits, rest), for each node at most `most`, those of fewest differing bits and
    then of least number. In the first round keys of many entries are read in part; later, nodes of one component are no
    candidates, nor are those that cannot be similar by their counts of shingles, and a node's list begins after its past.
    rest: the node has further ones (other may be null then)."""

    def run(batches):
        got = _gathered(batches, [*columns(words), *(() if first else STATE)])
        if got is None:
            return
        route, key, left, nodes, node, value = got
        bits, state = [x.view(np.uint64) for x in value[:words]], value[words:]
        counts = None if first else np.stack(state[4:], 1).view(np.uint8)
        rest = np.zeros(len(nodes), bool)
        held = [np.empty((3, 0), np.int64)]  # node, differing bits, other

        def shortened() -> np.ndarray:
            x, d, y = np.concatenate(held, axis=1)
            order = np.lexsort((y, d, x))
            x, d, y = x[order], d[order], y[order]
            new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(x) else np.empty(0, bool)
            x, d, y = x[new], d[new], y[new]
            place = np.arange(len(x)) - np.searchsorted(x, x)
            rest[x[place >= most]] = True
            keep = place < most
            return np.stack([x[keep], d[keep], y[keep]])

        size = 0
        for a, b in lookups(route, key, left, node, words, segments, lead, radius, WIDE if first else None):
            if a is None:
                rest[b] = True
                continue
            if not first:
                apart = state[0][a] != state[0][b]
                a, b = a[apart], b[apart]
            d = differing(bits, a, b)
            near = d <= distance
            a, b, d = a[near], b[near], d[near]
            if not first:
                able = can_be_similar(counts, state[3], a, b, jaccard)
                a, b, d = a[able], b[able], d[able]
            x, d, y = np.concatenate([a, b]), np.concatenate([d, d]), np.concatenate([b, a])
            if not first:
                later = (d > state[1][x]) | (d == state[1][x]) & (nodes[y] > state[2][x])
                x, d, y = x[later], d[later], y[later]
            held.append(np.stack([x, d, y]))
            size += len(x)
            if size > HELD:
                held = [shortened()]
                size = held[0].shape[1]
        x, d, y = shortened()
        alone = np.setdiff1d(np.flatnonzero(rest), x)
        columns_ = {"fp": pa.array(nodes[np.concatenate([x, alone])], pa.int64()), "other": pa.array([*nodes[y].tolist(), *[None] * len(alone)], pa.int64()), "bits": pa.array([*d.tolist(), *[None] * len(alone)], pa.int64()), "rest": pa.array(rest[np.concatenate([x, alone])])}
        yield pa.RecordBatch.from_pydict(columns_)
        del got, route, key, left, nodes, node, bits, value, state, held
        give_back()

    return run


def _lead(n: int, words: int, segments: int, radius: int) -> int:
    """Leading bits of a segment by which its table is dealt to n tasks."""
    lead = min(min(b for _, b in layout(segments)) - 1, max(1, int(np.ceil(np.log2(4 * n / (segments * words))))))
    while lead > 1 and len(ball(lead, radius)) > FLIPS:
        lead -= 1
    return lead


def links(distinct: DataFrame, distance: int = RADIUS, words: int = 1, reach: int | None = None, segments: int | None = None) -> DataFrame:
    """(a, b) pairs of fp that span the same components as all links found between the fingerprints.

    segments: of a word, 3 up to 2**23 fingerprints, 2 beyond, so that a segment has about as many values as there are
    rows; always 3 if a reach is given, as what a fixed reach finds depends on the segments. reach: radius of the balls;
    by default the one that finds every link.
    """
    n = partitions(distinct)
    segments = segments or (3 if reach is not None or distinct.count() < 1 << 23 else 2)
    radius = distance // (segments * words) if reach is None else reach
    lead = _lead(n, words, segments, radius)
    kind = ", ".join(f"{c} long" for c in ("fp", *columns(words)))
    dealt = distinct.select("fp", *columns(words)).mapInArrow(_deal(words, segments, lead, radius), f"route long, key long, left int, {kind}")
    return dealt.repartition(n, "route").mapInArrow(_match(words, segments, lead, radius, distance), "a long, b long").distinct()


def _join(batches):
    """All links of a partition to (node, root) for each node that is no root."""
    got = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if len(b)]
    if got:
        a, b = (np.concatenate(x) for x in zip(*got))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = forest(at[: len(a)], at[len(a) :], len(nodes))
        linked = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_pydict({"a": pa.array(nodes[linked], pa.int64()), "b": pa.array(nodes[root[linked]], pa.int64())})


def components(pairs: DataFrame) -> DataFrame:
    """(a, b): each node that is no root, and the root (smallest node) of its component.

    Up to ONE_TASK links are joined by one task (some tens of MB); more by rounds of large and small stars.
    """
    edges, before = durable(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), None
    total = edges.count()
    if total <= ONE_TASK:
        return durable(edges.coalesce(1).mapInArrow(_join, "a long, b long"))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("rows"))
        large = join_groups(both.where("b > a"), low, ["a"], 2 * total).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = durable(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("rows"))
        small = join_groups(large, low, ["a"], total)
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        edges = durable(small.distinct())
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == before:
            return edges
        before, total = state, state[0]


def _distinct(rows: DataFrame, words: int) -> DataFrame:
    """The distinct fingerprints with their number of rows and `first`, the least (doc_id, text_hash) among them."""
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("first")
    return durable(rows.groupBy("fp", *columns(words)).agg(first, F.min("text_hash").alias("any_text"), F.count(F.lit(1)).alias("n")))


def _rooted(distinct: DataFrame, roots: DataFrame) -> DataFrame:
    found = distinct.join(roots.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left")
    return durable(found.select("fp", "first", "n", F.coalesce("root", "fp").alias("root")))


def _named(rows: DataFrame, rooted: DataFrame, name: str, value) -> DataFrame:
    """Rows with `name`, an aggregate over the fingerprints of their component. Large groups are not shuffled together."""
    groups = rooted.groupBy("root").agg(value.alias(name), F.count(F.lit(1)).alias("rows"))
    named = join_groups(rooted, groups, ["root"], rooted.count())
    return join_groups(rows, durable(named.select("fp", name, F.col("n").alias("rows"))), ["fp"], rows.count())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = RADIUS, shingle: int = SHINGLE, words: int = 1, reach: int | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits a word), component_id (smallest doc_id that links reach) for every row."""
    rows = durable(fingerprints(docs, id_col, text_col, shingle, words))
    distinct = _distinct(rows, words)
    rooted = _rooted(distinct, components(links(distinct, distance, words, reach)))
    digits = F.concat(*(F.lpad(F.lower(F.hex(c)), 16, "0") for c in columns(words)))
    return _named(rows, rooted, "component_id", F.min("first.doc_id")).select("doc_id", digits.alias("fingerprint"), "component_id")


def _check(shingle: int, jaccard: float):
    """Rows (b, salt, a, text) in order, b's own text (a null) before those to compare with it, to the links (a, b) that hold."""

    def run(batches):
        hub, whose = None, None
        for batch in batches:
            found = []
            for b, a, text in zip(*(batch.column(c).to_pylist() for c in ("b", "a", "text"))):
                own = np.unique(shingles(text.encode(), shingle))
                if a is None:
                    hub, whose = own, b
                    continue
                if whose != b:
                    raise ValueError(f"no text of {b}")
                both = len(np.intersect1d(own, hub, assume_unique=True))
                if both >= jaccard * (len(own) + len(hub) - both):
                    found.append((a, b))
            yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _checked(pairs: DataFrame, texts: DataFrame, shingle: int, jaccard: float, n: int) -> DataFrame:
    """Pairs (a, b) whose texts' sets of shingles are similar. A node in many pairs is b there; its pairs are dealt in
    shares of about SHARE, each with the text of b once."""
    held = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("rows"))
    held = held.withColumn("shares", F.ceil(F.col("rows") / F.lit(SHARE)).cast("long"))
    salted = join_groups(pairs, held, ["b"], pairs.count()).withColumn("salt", F.pmod(F.xxhash64("a"), F.col("shares"))).drop("shares")
    members = salted.join(texts.withColumnRenamed("fp", "a"), "a").select("b", "salt", "a", "text")
    hubs = salted.select("b", "salt").distinct().join(texts.withColumnRenamed("fp", "b"), "b").select("b", "salt", F.lit(None).cast("long").alias("a"), "text")
    rows = members.unionByName(hubs).repartition(n, "b", "salt").sortWithinPartitions("b", "salt", F.asc_nulls_first("a"))
    return rows.mapInArrow(_check(shingle, jaccard), "a long, b long")


def _counted(going: DataFrame, distinct: DataFrame, body: DataFrame, shingle: int) -> DataFrame:
    """going with size and the counts by class."""
    names = STATE[3:]

    def run(batches):
        for batch in batches:
            sets = [np.unique(shingles(t.encode(), shingle)) for t in batch.column("text").to_pylist()]
            found = np.array([lanes(x) for x in sets], np.uint8).reshape(-1, LANES).view(np.int64)
            own = [batch.column("fp"), pa.array([len(x) for x in sets], pa.int64()), *(pa.array(found[:, k]) for k in range(LANES // 8))]
            yield pa.RecordBatch.from_arrays(own, ["fp", *names])

    return going.join(_texts(going.select("fp"), distinct, body).mapInArrow(run, "fp long, " + ", ".join(f"{c} long" for c in names)), "fp")


def _texts(nodes: DataFrame, distinct: DataFrame, body: DataFrame) -> DataFrame:
    """(fp, text): a text of each of these nodes (fp)."""
    wanted = nodes.distinct()
    wanted = durable(wanted.join(distinct.select("fp", F.col("any_text").alias("text_hash")), "fp"))
    small = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    return durable(body.join(small, "text_hash").select("fp", "text").dropDuplicates(["fp"]))


def similar(body: DataFrame, distinct: DataFrame, distance: int, shingle: int, words: int, reach: int | None, jaccard: float, segments: int = 3) -> DataFrame:
    """(a, b): roots of the components that candidates of at least `jaccard` similarity make, as `components` gives them.

    body: doc_id, text_hash, text. A round hands in each node's nearest candidates and checks them; nodes that have more go on,
    without candidates of their own component and from where they were. Ends when no node has more.
    """
    n, radius = partitions(body), distance // (segments * words) if reach is None else reach
    lead, most, first, roots, links_ = _lead(n, words, segments, radius), TRIES, True, None, None
    going = distinct.select("fp", *columns(words))
    while True:
        more = () if first else STATE
        kind = ", ".join(f"{c} long" for c in ("fp", *columns(words), *more))
        dealt = going.mapInArrow(_deal(words, segments, lead, radius, more), f"route long, key long, left int, {kind}")
        found = dealt.repartition(n, "route").mapInArrow(_nearest(words, segments, lead, radius, distance, jaccard, most, first), "fp long, other long, bits long, rest boolean")
        found = durable(found.groupBy("fp", "other", "bits").agg(F.max("rest").alias("rest")))
        own = Window.partitionBy("fp")
        ranked = found.withColumn("place", F.row_number().over(own.orderBy(F.asc_nulls_last("bits"), "other"))).withColumn("rest", F.max(F.col("rest") | (F.col("place") > most) & F.col("other").isNotNull()).over(own))
        picked = durable(ranked.where(F.col("place") <= most))
        both = picked.where("other is not null").groupBy(F.least("fp", "other").alias("l"), F.greatest("fp", "other").alias("g")).agg(F.min("fp").alias("a"))
        pairs = durable(both.select("a", F.when(F.col("a") == F.col("l"), F.col("g")).otherwise(F.col("l")).alias("b")))
        if pairs.limit(1).count():
            held = durable(_checked(pairs, _texts(pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))), distinct, body), shingle, jaccard, n))
            links_ = held if links_ is None else durable(links_.unionByName(held))
            roots = components(links_)
        going_on = picked.where("rest").groupBy("fp").agg(F.max(F.struct(F.coalesce("bits", F.lit(-1)), F.coalesce("other", F.lit(0)))).alias("last"))
        going_on = going_on.select("fp", "last.*").toDF("fp", "past", "past_other")
        if first:  # keys were read in part, so lists begin anew
            going_on = going_on.select("fp", F.lit(-1).cast("long").alias("past"), F.lit(0).cast("long").alias("past_other"))
        if roots is None:
            roots = body.sparkSession.createDataFrame([], "a long, b long")
        going = distinct.select("fp", *columns(words)).join(going_on, "fp").join(roots.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left")
        going = durable(going.withColumn("root", F.coalesce("root", "fp")))
        left = going.count()
        if not left:
            return roots
        lead = min(_lead(n, words, segments, radius), max(1, (left // ROUTE_ROWS).bit_length()))  # no more flips than the rows need
        going = settled(_counted(going, distinct, body, shingle))
        most, first = most * 4, False


def _without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs without the rows of these (doc_id, text_hash): an id may have several texts."""
    gone = gone.select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__hash"))
    plain, names = renamed(docs)
    own = F.xxhash64(F.coalesce(F.col(names[text_col]).cast("string"), F.lit("")))
    return plain.join(gone, (F.col(names[id_col]).cast("long") == F.col("__gone")) & (own == F.col("__hash")), "left_anti").toDF(*docs.columns)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = RADIUS, shingle: int = SHINGLE, words: int = 1, reach: int | None = None, jaccard: float | None = None) -> DataFrame:
    """The row of least id in each component (of several texts of that id, one), with all its columns; rows of null id stay.

    jaccard: links also need this similarity of the texts' sets of shingles.
    """
    rows = durable(fingerprints(docs, id_col, text_col, shingle, words, jaccard is not None))
    distinct = _distinct(rows, words)
    if jaccard is None:
        roots = components(links(distinct, distance, words, reach))
    else:
        body = pick(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
        roots = similar(body, distinct, distance, shingle, words, reach, jaccard)
    named = _named(rows, _rooted(distinct, roots), "least", F.min("first"))
    gone = named.where("doc_id <> least.doc_id OR text_hash <> least.text_hash").select("doc_id", "text_hash").distinct()
    return _without(docs, gone, id_col, text_col)
