"""Mixture-controlled packing by deficit round-robin.

Documents are spread over partitions by a hash, so that each holds its part of every source however the input is laid out,
and keep their order there. They are tokenised once into a durable table. Each partition of it packs its own documents: every source is a queue,
every window of SEQUENCE tokens credits each queue with its target share of the window, and queues with credit are served
in turn, at most TURN tokens of the head document a visit; what a queue is owed or has overdrawn (its deficit) carries
over to the next window. Across partitions the carry is known beforehand: what the targets promised a source over all
earlier partitions less what these held of it, from sums by partition and source. No token moves after that.

A partition's last tokens, fewer than a window, fill sequences whose sizes are the powers of two that add up to them, so
nothing is padded. A sequence's id is its partition's number times 2**32 plus its place there.

Cases: a null text counts as empty, and an empty document is its end id alone; null sources form a queue of their own;
null and repeated ids are packed like any other; an empty table gives no rows; other columns are not read; a document
longer than a window continues over several.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import LOWER, SPACE, durable, give_back, partitions, raw, slices, word_spans

SEQUENCE, TURN = 4096, 1024
END_ID = 2
CARRY_ROWS = 200_000  # (partition, source) sums up to which the carries are broadcast; beyond, they are joined by shuffle
CACHE = 200_000
SLICE = 4 << 20
_loaded: dict = {}


#: The parts of a tokenizer file that make it work word by word, and the shape of its model.
FORM = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "truncation": None,
    "padding": None,
}
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
WIDTH = 16  # bytes of a piece up to which pieces are merged together
LATIN = (0xC0, 0x250)  # code points of Latin letters with marks, two bytes each
NONE = 1 << 27
#: Bytes of words that are cut here: printable ASCII but the apostrophe (contractions) and < (special tokens); white space.
PLAIN = SPACE.copy()
PLAIN[[*range(0x21, 0x27), *range(0x28, 0x3C), *range(0x3D, 0x7F)]] = True
KIND = np.full(256, 3, np.uint8)  # white space, letters, digits, others
KIND[SPACE] = 0
KIND[[*range(97, 123), *range(128, 256)]] = 1
KIND[48:58] = 2


def pair_tables(pairs: np.ndarray, n_ids: int) -> list[tuple[np.uint64, np.uint64, np.ndarray]]:
    """(factor, shift, table) levels: a pair's slot holds pair and rank; of pairs with one slot all but one go on to the next level."""
    if n_ids > 1 << 16:
        raise ValueError("ids of pairs take 16 bits")
    rest, out = np.arange(len(pairs)), []
    while len(rest):
        bits = max(6, int(4 * len(rest)).bit_length())
        factor, shift = np.uint64(0x9E3779B1 + 2 * len(out)), np.uint64(32 - bits)
        slot = (pairs[rest] * factor & np.uint64(0xFFFFFFFF)) >> shift
        table = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        _, one = np.unique(slot, return_index=True)
        table[slot[one]] = pairs[rest[one]] << np.uint64(16) | rest[one].astype(np.uint64)
        out.append((factor, shift, table))
        rest = np.delete(rest, one)
    return out


class WordTokenizer:
    """Ids as the tokenizer file gives them, computed by distinct piece of a word.

    A file of the FORM below drops white space and never merges across it, so a text's ids are those of its words in
    order, and a word's are those of its pieces. Words of plain Latin letters, digits and marks are cut into pieces, and
    the pieces' pairs merged, for all distinct pieces of a slice at once; all other words, and pieces over WIDTH bytes,
    go through the file's whole pipeline. Files of any other form are applied to whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        form = json.loads(self.whole.to_str())
        model = form.pop("model")
        vocab, merges = model.pop("vocab"), model.pop("merges")
        self.by_word = all(form[k] == FORM[k] for k in FORM) and model == MODEL and all(t["special"] and "<" in t["content"] and not any(c.isspace() for c in t["content"]) for t in form["added_tokens"])
        self.cache: dict[bytes, np.ndarray] = {}
        if self.by_word:
            letter = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed: bytes that stand for themselves
            name = {b: chr(b) for b in letter} | {b: chr(256 + k) for k, b in enumerate(sorted({*range(256)} - {*letter}))}
            self.inner = np.array([vocab[name[b]] for b in range(256)], np.uint32)
            self.last = np.array([vocab[name[b] + MODEL["end_of_word_suffix"]] for b in range(256)], np.uint32)
            pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
            self.merged = np.array([vocab[a + b] for a, b in pairs], np.uint32)
            self.tables = pair_tables(np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint64), len(vocab))
            self.latin = np.zeros(LATIN[1] - LATIN[0], np.int64)  # lower-case code point, 0 if not handled here
            for c in map(chr, range(*LATIN)):
                low = self.whole.normalizer.normalize_str(c)
                if c.isalpha() and len(low) == 1 and low.isalpha() and LATIN[0] <= ord(low) < LATIN[1]:
                    self.latin[ord(c) - LATIN[0]] = ord(low)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, NONE without a merge."""
        key = left.astype(np.uint64) << np.uint64(16) | right
        out = np.full(key.shape, NONE, np.uint32)
        for factor, shift, table in self.tables:
            found = table[(key * factor & np.uint64(0xFFFFFFFF)) >> shift]
            hit = found >> np.uint64(16) == key
            out[hit] = found[hit] & np.uint64(0xFFFF)
        return out

    def merge(self, pieces: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (n x WIDTH, filled from the left) and their number, of distinct pieces given as rows of `size` bytes each.

        Until no pair of a piece has a rank, its leftmost pair of least rank becomes one id; pieces of a length advance together.
        """
        out, count = np.zeros((len(pieces), WIDTH), np.uint32), np.ones(len(pieces), np.int64)
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            ids = self.inner[pieces[at, :n].T]
            ids[n - 1] = self.last[pieces[at, n - 1]]
            rank = self._ranks(ids[:-1], ids[1:])
            for width in range(int(n), 0, -1):
                place = np.arange(width, dtype=np.uint32)[:, None]
                best = (rank << np.uint32(4) | place[:-1]).min(axis=0) if width > 1 else np.full(len(at), NONE << 4, np.uint32)
                done = best >> np.uint32(4) == NONE
                if done.any():
                    out[at[done], :width], count[at[done]] = ids[:, done].T, width
                    at, ids, rank, best = at[~done], ids[:, ~done], rank[:, ~done], best[~done]
                if not len(at):
                    break
                where, column = best & np.uint32(15), np.arange(len(at))
                ids = np.where(place[:-1] <= where, ids[:-1], ids[1:])
                ids[where, column] = self.merged[best >> np.uint32(4)]
                rank = np.where(place[:-2] < where, rank[:-1], rank[1:])
                some = np.flatnonzero(where > 0)
                rank[where[some] - 1, some] = self._ranks(ids[where[some] - 1, some], ids[where[some], some])
                some = np.flatnonzero(where < width - 2)
                rank[where[some], some] = self._ranks(ids[where[some], some], ids[where[some] + 1, some])
        return out, count

    def _odd(self, units: list[bytes]) -> list[np.ndarray]:
        """Ids of distinct words or pieces by the file's whole pipeline; short ones are kept, CACHE at most."""
        out = [self.cache.get(u) for u in units]
        missing = [k for k, x in enumerate(out) if x is None]
        for a in range(0, len(missing), 2000):  # the library's results are large
            some = missing[a : a + 2000]
            for k, e in zip(some, self.whole.encode_batch_fast([units[k].decode() for k in some], add_special_tokens=False)):
                out[k] = np.array(e.ids, np.uint32)
                if len(units[k]) <= 64:
                    if len(self.cache) >= CACHE:
                        self.cache.clear()
                    self.cache[units[k]] = out[k]
        return out

    def texts(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, each text's followed by end_id, and the n + 1 offsets of their runs."""
        if not self.by_word:
            found = [[*e.ids, end_id] for e in self.whole.encode_batch_fast(column.to_pylist(), add_special_tokens=False)]
            return np.array([i for x in found for i in x], np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        body, at = raw(column)
        low, plain = LOWER[body], PLAIN[body]
        lead = np.flatnonzero((body >= 0xC0 | LATIN[0] >> 6) & (body <= 0xC0 | LATIN[1] - 1 >> 6))
        point = (body[lead] & 31).astype(np.int64) << 6 | body[lead + 1] & 63
        small = self.latin[point - LATIN[0]] if len(lead) else point
        lead, small = lead[small > 0], small[small > 0]
        low[lead], low[lead + 1] = 0xC0 | small >> 6, 0x80 | small & 63
        plain[lead] = plain[lead + 1] = True
        begin, end = word_spans(body, at)
        foreign = np.zeros(len(body) + 1, np.int32)
        np.cumsum(~plain, out=foreign[1:])
        odd = foreign[end] > foreign[begin]
        del foreign, plain  # here and below: arrays many times the slice's size go when read
        kind = KIND[low]
        starts = np.zeros(len(body) + 1, bool)
        starts[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        starts[:-1] &= kind > 0
        change = np.zeros(len(body) + 1, np.int8)  # no pieces inside odd words
        change[begin[odd]] += 1
        change[end[odd]] -= 1
        starts &= np.cumsum(change, dtype=np.int8) == 0
        starts[begin] = True
        first = np.flatnonzero(starts[:-1])
        del kind, starts, change
        word = np.searchsorted(begin, first, "right") - 1
        last = np.minimum(np.append(first[1:], len(body)), end[word]) if len(first) else first
        size = last - first
        slow = odd[word] | (size > WIDTH) if len(first) else np.empty(0, bool)
        n_at, start_at = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        fast = np.flatnonzero(~slow)
        flat = [np.empty(0, np.uint32)]
        if len(fast):
            shown = np.lib.stride_tricks.sliding_window_view(np.concatenate([low, np.zeros(WIDTH, np.uint8)]), WIDTH)[first[fast]]
            shown *= np.arange(WIDTH) < size[fast, None]
            coded = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH), len(fast), [None, pa.py_buffer(shown)]).dictionary_encode()
            pieces = np.frombuffer(coded.dictionary.buffers()[1], np.uint8, len(coded.dictionary) * WIDTH).reshape(-1, WIDTH)
            which = coded.indices.to_numpy()
            del shown, coded
            ids, count = self.merge(pieces, (pieces > 0).sum(1))
            flat.append(ids[np.arange(WIDTH) < count[:, None]])
            n_at[fast], start_at[fast] = count[which], (np.cumsum(count) - count)[which]
            del ids, pieces, which
        rest = np.flatnonzero(slow)
        if len(rest):
            data, number = body.tobytes(), {}
            which = np.array([number.setdefault(data[a:b], len(number)) for a, b in zip(first[rest].tolist(), last[rest].tolist())], np.int64)
            found = self._odd(list(number))
            count = np.array([len(x) for x in found], np.int64)
            n_at[rest], start_at[rest] = count[which], (len(flat[-1]) + np.cumsum(count) - count)[which]
            flat += found
        flat = np.concatenate(flat)
        total = np.concatenate([[0], np.cumsum(n_at)])
        ends = total[np.searchsorted(first, at[1:])] + np.arange(1, len(at))
        del low, first, word, last, size, slow, fast, rest
        out = np.full(total[-1] + len(at) - 1, end_id, np.uint32)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = False
        place = np.repeat(start_at - total[:-1], n_at)
        place += np.arange(total[-1])
        out[inner] = flat[place]
        return out, np.concatenate([[0], ends])


def tokenizer(path: str) -> WordTokenizer:
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A durable table (part, pos, doc_id, source, n, ids) of documents' ids as packed unsigned integers."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(source_col).cast("string").alias("source"))

    def run(batches):
        tool, part, pos = tokenizer(path), TaskContext.get().partitionId(), 0
        give_back()  # what earlier tasks have left in this worker
        wide = "<u2" if tool.whole.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"
        for batch in batches:
            _, at = raw(batch.column("text"))
            for a, b in slices(at, SLICE):
                ids, ends = tool.texts(batch.column("text").slice(a, b - a), end_id)
                ids, width = ids.astype(wide).tobytes(), int(wide[2])
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(b - a, part), pa.int64()), "pos": pa.array(np.arange(pos, pos + b - a), pa.int64()), "doc_id": batch.column("doc_id").slice(a, b - a), "source": batch.column("source").slice(a, b - a),
                    "n": pa.array(np.diff(ends), pa.int64()), "width": pa.array(np.full(b - a, width), pa.int32()), "ids": pa.array([ids[width * x : width * y] for x, y in zip(ends[:-1], ends[1:])], pa.binary()),
                })
                pos += b - a
                del ids, ends
            give_back()

    return durable(rows.mapInArrow(run, "part long, pos long, doc_id long, source string, n long, width int, ids binary"))


def carries(tokens: DataFrame, targets: dict | None = None) -> DataFrame:
    """Per partition: its queues as (source, share, deficit). Targets default to the sources' shares of all tokens."""
    sums = durable(tokens.groupBy("part", "source").agg(F.sum("n").alias("held")))
    parts = sums.groupBy("part").agg(F.sum("held").alias("all"))
    earlier = lambda w: F.coalesce(F.sum(w[1]).over(w[0].orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", earlier((Window.partitionBy(), "all")).alias("before"))  # one row for each partition
    if targets is None:
        every = sums.agg(F.sum("held")).first()[0] or 1
        shares = sums.groupBy("source").agg((F.sum("held") / F.lit(every)).alias("share")).withColumnRenamed("source", "s")
    else:
        shares = tokens.sparkSession.createDataFrame([(k, float(v)) for k, v in targets.items()], "s string, share double")
    own = sums.withColumn("own_before", earlier((Window.partitionBy("source"), "held")))
    rows = own.join(parts, "part").join(shares, own["source"].eqNullSafe(shares["s"]), "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    queue = F.struct("source", "share", (F.col("share") * F.col("before") - F.col("own_before")).alias("deficit"))
    return rows.groupBy("part").agg(F.sort_array(F.collect_list(queue)).alias("queues"))


def windows(total: int, size: int = SEQUENCE) -> list[int]:
    """Window sizes for `total` tokens: full ones, then the powers of two that add up to the rest."""
    rest = total % size
    return [size] * (total // size) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def round_robin(lengths: list[int], queue_of: list[int], shares: list[float], deficits: list[float], size: int = SEQUENCE, turn: int = TURN):
    """Yield (document, start, length, window, offset): pieces in the order of the windows that they fill."""
    queues: list[list[int]] = [[] for _ in shares]
    for doc in range(len(lengths) - 1, -1, -1):
        queues[queue_of[doc]].append(doc)
    floor = 1e-6
    weight = [max(floor, s) for s in shares]
    deficit, done, at = list(deficits), [0] * len(lengths), 0
    live = [q for q in range(len(queues)) if queues[q]]
    mean = sum(deficit[q] for q in live) / max(1, len(live))
    deficit = [d - mean for d in deficit]
    for window, room in enumerate(windows(sum(lengths), size)):
        offset = 0
        credit = room
        while offset < room:
            scale = credit / sum(weight[q] for q in live)
            scale = max(scale, min((1 - deficit[q]) / weight[q] for q in live))  # all far overdrawn: as many credits at once
            for q in live:
                deficit[q] += weight[q] * scale
            credit = room
            for _ in range(len(live)):
                if at >= len(live):
                    at = 0
                q = live[at]
                while deficit[q] > 0 and offset < room and queues[q]:
                    doc = queues[q][-1]
                    left = lengths[doc] - done[doc]
                    take = min(left if left < 2 * turn else turn, room - offset)
                    yield doc, done[doc], take, window, offset
                    done[doc] += take
                    offset += take
                    deficit[q] -= take
                    if done[doc] == lengths[doc]:
                        queues[q].pop()
                    if left >= 2 * turn:
                        break
                if not queues[q]:
                    live.pop(at)
                elif offset < room:
                    at += 1
                if offset >= room or not live:
                    break


def _pack(size: int, turn: int):
    def part(rows: list[dict]):
        queues = rows[0]["queues"] or []
        index = {q["source"]: k for k, q in enumerate(queues)}
        lengths = [r["n"] for r in rows]
        data = [np.frombuffer(r["ids"], f"<u{r['width']}") for r in rows]
        for doc, start, length, window, offset in round_robin(lengths, [index[r["source"]] for r in rows], [q["share"] for q in queues], [q["deficit"] for q in queues], size, turn):
            row = rows[doc]
            yield row["doc_id"], start, length, zlib.crc32(data[doc][start : start + length].astype("<u4").tobytes()), row["n"], (row["part"] << 32) + window, offset, row["source"]

    def run(batches):
        from ._blocks import grouped

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
        for _, rows in grouped(batches, "part"):
            found = list(zip(*part(rows)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 7 else pa.int64()) for k, c in enumerate(found)], names)
        give_back()

    return run


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def spread(docs: DataFrame, *columns: str) -> DataFrame:
    """These columns of docs, rows dealt by a hash of their place; each partition in the order of the places."""
    rows = docs.select(*columns).withColumn("__at", F.monotonically_increasing_id()).withColumn("__to", F.xxhash64("__at"))
    return rows.repartition(partitions(docs), "__to").sortWithinPartitions("__at").drop("__at", "__to")


def pack(docs: DataFrame, path: str, targets: dict | None = None, size: int = SEQUENCE, turn: int = TURN, end_id: int = END_ID, **columns: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source."""
    names = [columns.get(f"{c}_col", d) for c, d in (("id", "doc_id"), ("text", "text"), ("source", "source"))]
    tokens = tokenised(spread(docs, *dict.fromkeys(names)), path, end_id, **columns)
    carry = durable(carries(tokens, targets))
    small = (carry.agg(F.sum(F.size("queues"))).first()[0] or 0) <= CARRY_ROWS
    joined = tokens.join(F.broadcast(carry) if small else carry, "part", "left").withColumn("queues", F.when(F.col("pos") == 0, F.col("queues")))
    return joined.sortWithinPartitions("part", "pos").mapInArrow(_pack(size, turn), PIECE)


def sequences(pieces: DataFrame) -> DataFrame:
    """Per sequence: its tokens, its padding up to SEQUENCE (none at a power of two) and its sources' tokens."""
    own = pieces.groupBy("sequence_id", "source").agg(F.sum("length").alias("held"))
    rows = own.groupBy("sequence_id").agg(F.sum("held").alias("tokens"), F.sort_array(F.collect_list(F.struct("source", "held"))).alias("mixture"))
    return rows.withColumn("padding", F.when(F.bit_count("tokens") == 1, 0).otherwise(SEQUENCE - F.col("tokens")))
