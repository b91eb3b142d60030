"""Token ids in a byte-aligned variable-length file format.

Ids of a corpus are replaced by their rank in its frequency order (rank 0: the
most frequent id, ties to the smaller id).  A block holds the ranks of a run of
whole documents: two control bits for each rank say how many of the four
little-endian bytes it takes (1 to 4); the control bytes stand before the data
bytes, so that a decoder finds all lengths by one table lookup for each
control byte and gathers the data bytes with numpy.

A token file is a folder: ``blocks`` (Parquet; one row for each block, in
ascending doc_id order by ``seq``, with the encoded bytes as a binary column,
written by Spark's committer so that lost executors leave no half files) and
``ranks`` (the ids by rank).  ``export_raw`` turns a block into bytes that
``parse_raw`` reads without Spark.

Encoding goes through the tokenizers library.  Where the tokenizer drops ASCII
white space, words are encoded once for each worker and looked up afterwards;
the ids equal those of the whole text, which the tests check.

Defined results: a null text is an empty text and has the end id alone;
repeated rows stay, ordered by doc_id and then by their ids' bytes; null
doc_ids come first; an empty table makes an empty file; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import drop, new_path

END_ID = 2
#: A block holds about so many ids, of whole documents.  Ranges of doc_id follow blocks of about so many documents.
BLOCK_IDS, RANGE_DOCS, MAX_RANGES = 1_000_000, 8_192, 65_536
CACHE_WORDS = 400_000
#: So many blocks at most (about 40 bytes each) are sent to every executor.
BROADCAST_BLOCKS = 500_000
MAGIC = b"TOKR0001"
# letters whose lower case is one letter and which have no other composed form, then signs that the tokenizer splits from letters
_PLAIN, _SIGNS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[!-&(-/:-@\\[-`{-~]*$", "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

# ------------------------------------------------------------------- format

_SIZES = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def pack(ranks: np.ndarray) -> bytes:
    """Count, control bytes and data bytes of ranks below 2**32."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    n = len(ranks)
    sizes = (1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    padded = np.zeros(-(-n // 4) * 4, np.uint8)
    padded[:n] = sizes - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8)[None, :] < sizes[:, None]]
    return n.to_bytes(8, "little") + control.tobytes() + data.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    groups = -(-n // 4)
    sizes = _SIZES[np.frombuffer(raw, np.uint8, groups, 8)].reshape(-1)[:n]
    data = np.frombuffer(raw, np.uint8, offset=8 + groups)
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4, dtype=np.uint8)[None, :] < sizes[:, None]] = data
    return out.reshape(-1).view("<u4")


def export_raw(lengths: np.ndarray, payload: bytes) -> bytes:
    """One block as a stand-alone file: magic, packed lengths of its documents, packed ranks."""
    head = pack(np.asarray(lengths))
    return MAGIC + len(head).to_bytes(8, "little") + head + payload


def parse_raw(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    if raw[:8] != MAGIC:
        raise ValueError("not a token block")
    n = int.from_bytes(raw[8:16], "little")
    return unpack(raw[16 : 16 + n]), unpack(raw[16 + n :])


# ------------------------------------------------------------------ encoding


class WordEncoder:
    """Ids of each of some texts, little-endian unsigned 32-bit."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        ids = self.tok.encode("a \t\nb", add_special_tokens=False).ids
        apart = [self.tok.encode(x, add_special_tokens=False).ids for x in "ab"]
        self.by_word = ids == apart[0] + apart[1]
        self.ends = None
        suffix = getattr(self.tok.model, "end_of_word_suffix", None)
        if suffix:
            names = self.tok.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(names.values()) + 1, bool)
            self.ends[[i for name, i in names.items() if name.endswith(suffix)]] = True
        both = [self.tok.encode(x, add_special_tokens=False).ids for x in ("ab", ".,", "Ab.,")]
        self.by_part = self.by_word and both[2] == both[0] + both[1]
        self.forget()

    def forget(self) -> None:
        """Empty the table of parts: for each its number, and of the numbers their ids, joined, with where they begin and end."""
        self.parts, self.held = {}, 0
        self.ids, self.ends_at = np.zeros(1 << 16, "<u4"), np.zeros(1 << 16, np.int64)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Joined ids and their numbers of texts as the tokenizer gives them."""
        found = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found))

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As _encode, for parts that are one word to the tokenizer: many go in a text, and ids that end words part them again."""
        if self.ends is not None:
            ids, _ = self._encode([" ".join(parts[i : i + 64]) for i in range(0, len(parts), 64)])
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(parts):
                return ids, np.diff(ends, prepend=0)
        return self._encode(parts)

    def _hold(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, start = len(self.parts), self.held
        self.held += len(ids)
        while self.held > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(parts) >= len(self.ends_at):
            self.ends_at = np.concatenate([self.ends_at, np.zeros_like(self.ends_at)])
        self.ids[start : self.held] = ids
        self.ends_at[n + 1 : n + 1 + len(parts)] = start + np.cumsum(sizes)
        self.parts.update(zip(parts, range(n, n + len(parts))))

    def _numbers(self, words: pa.StringArray, whole: bool) -> np.ndarray:
        """The numbers of these words in the table; words that the tokenizer may cut are encoded one by one (``whole``)."""
        d = words.dictionary_encode()
        names = d.dictionary.to_pylist()
        found = [*map(self.parts.get, names)]
        if lacking := [i for i, x in enumerate(found) if x is None]:
            new, first = [names[i] for i in lacking], len(self.parts)
            self._hold(new, *(self._encode(new) if whole else self._encode_parts(new)))
            for n, i in enumerate(lacking, first):
                found[i] = n
        return np.array(found, np.int64)[d.indices.to_numpy()]

    def __call__(self, texts: list[str], end_id: int | None = None) -> list[np.ndarray]:
        """Ids of each text, with ``end_id`` after them if one is given."""
        ids, sizes = self._by_words(texts) if self.by_word else self._encode(texts)
        ends = np.cumsum(sizes)
        if end_id is not None:
            ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
        return np.split(ids, ends[:-1]) if len(ends) else []

    def _by_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > CACHE_WORDS:
            self.forget()
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        d = split.values.dictionary_encode()
        words = d.dictionary
        # a word is a part, or letters and then signs, in two parts; an empty one (at the ends of a text) is none
        head, tail = np.full(len(words), -1), np.full(len(words), -1)
        plain = pc.match_substring_regex(words, _PLAIN).to_numpy(zero_copy_only=False) if self.by_part else np.zeros(len(words), bool)
        own = words.filter(pa.array(plain))
        letters = pc.utf8_rtrim(own, _SIGNS)
        cut = pc.binary_length(letters).to_numpy() < pc.binary_length(own).to_numpy()
        signs = pc.replace_substring_regex(own.filter(pa.array(cut)), "^[^!-@\\[-`{-~]+", "")
        head[plain] = self._numbers(pc.utf8_lower(letters), False)
        tail[np.flatnonzero(plain)[cut]] = self._numbers(signs, True)
        rest = ~plain & (pc.binary_length(words).to_numpy() > 0)
        head[rest] = self._numbers(words.filter(pa.array(rest)), True)
        # of each word in order its one or two numbers, then their ids
        at = d.indices.to_numpy()
        two = np.stack([head[at], tail[at]], 1).reshape(-1)
        starts = 2 * split.offsets.to_numpy().astype(np.int64)
        size = np.where(two >= 0, self.ends_at[two + 1] - self.ends_at[two], 0)
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(self.ends_at[two] - ends + size, size) + np.arange(size.sum())]
        return ids, np.diff(np.r_[0, ends][starts])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# ------------------------------------------------------------ writing, reading


def _narrow(ids: np.ndarray) -> bytes:
    """Ids for the way from task to task: 16 bits where they fit, compressed."""
    small = not len(ids) or ids.max() < 2**16
    return (b"\x02" if small else b"\x04") + zstandard.compress(ids.astype("<u2" if small else "<u4").tobytes(), 1)


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw[1:]), "<u2" if raw[:1] == b"\x02" else "<u4").astype("<u4")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS, range_docs: int = RANGE_DOCS) -> None:
    """Encode docs(doc_id, text) and write a token file at path."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = docs.count()
    ranges = min(MAX_RANGES, max(1, -(-n // range_docs)))
    # Approximate quantiles deal doc_ids into ranges of like numbers; any cuts keep the order.
    cuts = docs.stat.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else []
    cuts = spark.sparkContext.broadcast(np.unique(np.array(cuts or [], float)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = encoder(tokenizer)
        for b in batches:
            for i in range(0, len(b), 384):
                part = b.slice(i, 384)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = part.column("doc_id")
                at = np.searchsorted(cuts.value, ids.fill_null(-(2**63)).to_numpy(zero_copy_only=False).astype(float)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([ids, pa.array(at), pa.array([_narrow(x) for x in make(texts, end_id)], pa.binary())], names=["doc_id", "range", "ids"])

    raw_path = new_path(spark, "ids")
    encoded = docs.mapInArrow(encode, "doc_id long, range int, ids binary")
    encoded.repartition(max(1, len(cuts.value) + 1), "range").sortWithinPartitions("range", "doc_id", "ids").write.option("compression", "none").parquet(raw_path)
    raw = spark.read.parquet(raw_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1, np.int64)
        for b in batches:
            for i in range(0, len(b), 1024):
                c = np.bincount(np.concatenate([_wide(x) for x in b.column("ids")[i : i + 1024].to_pylist()]))
                if len(c) > len(seen):
                    c, seen = seen, c
                seen[: len(c)] += c
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(seen[at].astype(np.int64))], names=["id", "n"])

    counts = raw.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    by_rank = np.array([r.id for r in counts.orderBy(F.desc("n"), "id").collect()], "<u4")  # no more rows than the vocabulary has entries
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(by_rank)], "rank int, id long").coalesce(1).write.parquet(f"{path}/ranks")
    table = np.zeros(int(by_rank.max(initial=0)) + 1, "<u4")
    table[by_rank] = np.arange(len(by_rank))
    to_rank = spark.sparkContext.broadcast(table)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        ranks: list[np.ndarray] = []
        held, number, at = 0, 0, None

        def done() -> pa.RecordBatch:
            payload, lengths = pack(np.concatenate(ranks)), np.array([len(x) for x in ranks])
            row = {"range": at, "first": ids[0], "number": number, "n_ids": held, "ids": ids, "lengths": lengths, "crc": zlib.crc32(payload), "payload": payload}
            return pa.RecordBatch.from_pylist([row], schema=_BLOCKS)

        for b in batches:
            for r, d, x in zip(b.column("range").to_pylist(), b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                if ids and (r != at or held >= block_ids):
                    yield done()
                    ids, ranks, held, number = [], [], 0, number + 1
                at = r
                ids.append(d)
                ranks.append(to_rank.value[_wide(x)])
                held += len(ranks[-1])
        if ids:
            yield done()

    blocks = raw.select("range", "doc_id", "ids").mapInArrow(block, "range int, first long, number long, n_ids long, ids array<long>, lengths array<long>, crc long, payload binary")
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    drop(spark, raw_path)


_BLOCKS = pa.schema([("range", pa.int32()), ("first", pa.int64()), ("number", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("crc", pa.int64()), ("payload", pa.binary())])


def read_blocks(spark: SparkSession, path: str, most: int = BROADCAST_BLOCKS) -> DataFrame:
    """Blocks with ``before``: the ids of all blocks before it.

    The sums run over the ranges (at most MAX_RANGES short rows) and then inside each range.  A table of one short row for each
    block goes to the executors where it has ``most`` rows or fewer; else blocks and sums meet by their keys.
    """
    rows = spark.read.parquet(f"{path}/blocks")
    keys = ["range", "first", "number", "crc"]
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("range").agg(F.sum("n_ids").alias("n")).select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    order = Window.partitionBy("range").orderBy(F.asc_nulls_first("first"), "number", "crc").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.select(*keys, F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("inside"))
    before = inside.join(F.broadcast(ranges), "range").select(*keys, (F.col("base") + F.col("inside")).alias("before"))
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys]
    return rows.alias("l").join((F.broadcast(before) if rows.count() <= most else before).alias("r"), on).select("l.*", "before")


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids (or, with digest, their ids_crc32) of every document of a token file."""
    by_rank = np.array([r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], "<u4")
    ids_of = spark.sparkContext.broadcast(by_rank)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(len(b)):
                payload = b.column("payload")[row].as_py()
                if zlib.crc32(payload) != b.column("crc")[row].as_py():
                    raise ValueError("a block's bytes do not match its checksum")
                ids = ids_of.value[unpack(payload)] if len(ids_of.value) else np.zeros(0, "<u4")
                lengths = np.array(b.column("lengths")[row].as_py(), np.int64)
                ends = np.cumsum(lengths)
                parts = np.split(ids, ends[:-1])
                last = pa.array([zlib.crc32(p) for p in parts], pa.int64()) if digest else pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(b.column("ids")[row].as_py(), pa.int64()), pa.array(b.column("before")[row].as_py() + ends - lengths), pa.array(lengths), last], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    kind = "ids_crc32 long" if digest else "ids array<long>"
    return read_blocks(spark, path).select("ids", "lengths", "crc", "payload", "before").mapInArrow(decode, f"doc_id long, start long, n_tokens long, {kind}")
