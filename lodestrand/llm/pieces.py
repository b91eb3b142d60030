"""N-best SentencePiece segmentation over the piece lattice, and decoding.

The score of a segmentation is the sum of its pieces' scores in the model; a
character that no piece covers stands alone, scores the lowest piece score
less 10, and is spelled in the model's byte pieces.  A forward Viterbi pass
gives each position of a text its best score from the start; these scores are
the exact remaining cost of a search that runs backward from the end, so A*
takes segmentations from its heap in the order of their scores.

No piece reaches over a border of "not a word-start mark" and "word-start
mark", or over a line break, so a text's lattice is a chain of word lattices.
The forward pass and the search for the best path run once for each distinct
word of a worker, for all new words of a batch side by side in numpy arrays:
with an exact remaining cost the search for one path never leaves the best
path, so it takes one edge of each word in each step (words whose best edges
tie within rounding, long words and words with unknown characters go through
the heap).  The search for n paths opens only the words whose cheapest detour
can be among the n best, and their paths are joined into the chain.

Defined results: null and empty texts have no pieces and score 0; texts keep
all white space (the mark U+2581 itself reads as a space, as in the model);
among equal scores the order is that of the search, which prefers paths that
have come further back, and then pieces found first (of equal detours in two
words, the one in the earlier word); repeated rows each give a
row; an empty table gives no rows; columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NBEST, MARK = 4, "▁"
CACHE_WORDS, LONG_WORD = 400_000, 64
_CHAIN = re.compile("▁*[^▁\n]+|▁+|\n")
# Latin letters; for models without pieces of such letters and other signs together, words end where these meet
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u1e00-\u1eff"
_MIXED = re.compile(f"[{_LATIN}][^{_LATIN}]|[^▁{_LATIN}][{_LATIN}]")
_FINER_CHAIN = re.compile(f"▁*(?:[{_LATIN}]+|[^▁\n{_LATIN}]+)|▁+|\n")
_NONE, _ABSENT = float("-inf"), ()


class Pieces:
    """The pieces of a SentencePiece model; lattice, n-best search and decoding."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(size)]
        self.byte = {int(self.text[i][3:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.unknown = sp.unk_id()
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.known = {self.text[i]: (sp.get_score(i), i) for i in plain}
        #: of all beginnings of pieces: the piece, or None where it is none itself
        self.prefixes = {p[:i]: None for p in self.known for i in range(1, len(p))} | self.known
        self.longest = max((len(p) for p in self.known), default=1)
        # the score of a run of marks that stands for no merge is kept out of the lowest score
        self.lowest = min((s for s, _ in self.known.values() if s > -1e8), default=0.0) - 10.0
        if any("\n" in p or MARK in p.lstrip(MARK) for p in self.known):
            raise ValueError("a piece of this model reaches over a word border")
        mixed = any(_MIXED.search(p) for p in self.known)
        self.chain = (_CHAIN if mixed else _FINER_CHAIN).findall
        self._grow_trie()
        self.words: dict[str, int] = {}
        #: of the words, in order: best score, loss of the second best, best ids
        self.best, self.loss, self.ids = np.zeros(0), np.zeros(0), []
        #: of words that were opened: losses and ids of the n best
        self.opened: dict[tuple[str, int], list[tuple[float, bytes]]] = {}

    def edges(self, word: str, end: int) -> list[tuple[int, float, int]]:
        """(start, score, id) of the pieces that end there, longest first; id -1: no piece, one character."""
        found = [(start, *self.known[p]) for start in range(max(0, end - self.longest), end) if (p := word[start:end]) in self.known]
        return found if found and found[-1][0] == end - 1 else [*found, (end - 1, self.lowest, -1)]

    def forward(self, word: str) -> tuple[list[float], list[tuple[int, float, int]]]:
        """Best score from the start to each position, and the last edge there."""
        best, last = [0.0], [(0, 0.0, -1)]
        for end in range(1, len(word) + 1):
            top, edge = _NONE, None
            for e in self.edges(word, end):
                if (s := best[e[0]] + e[1]) > top:
                    top, edge = s, e
            best.append(top)
            last.append(edge)
        return best, last

    def lattice(self, word: str) -> tuple[list[float], list[list[tuple[int, float, int]]]]:
        """What forward and edges give, from the known beginnings of pieces: best score to each position, and the edges into it."""
        n, far, get, known, lowest = len(word), self.longest, self.prefixes.get, self.known, self.lowest
        best, into = [0.0] + [_NONE] * n, [[] for _ in range(n + 1)]
        for start in range(n):
            behind = best[start]
            for end in range(start + 1, min(n, start + far) + 1):
                piece = get(word[start:end], _ABSENT)
                if piece:
                    into[end].append((start, *piece))
                    if (s := behind + piece[0]) > best[end]:
                        best[end] = s
                elif piece is _ABSENT:
                    break
            if word[start] not in known:
                into[start + 1].append((start, lowest, -1))
                if (s := behind + lowest) > best[start + 1]:
                    best[start + 1] = s
        return best, into

    def search(self, best: list[float], into: list, n: int) -> list[tuple[float, list[tuple[int, int, int]]]]:
        """The n best paths by A* from the end, best first, as (start, end, id) in order."""
        # for one path, edges that cost more than rounding does are never taken from the heap
        least = best[-1] - 1e-6 - 1e-9 * abs(best[-1]) if n == 1 else _NONE
        heap, made, out = [(-best[-1], len(best) - 1, 0, 0.0, None)], 0, []
        while heap and len(out) < n:
            cost, at, _, behind, path = heapq.heappop(heap)
            if at == 0:
                steps = []
                while path:
                    step, path = path
                    steps.append(step)
                out.append((-cost, steps))
                continue
            for start, score, i in into[at]:
                if (whole := best[start] + score + behind) >= least:
                    made += 1
                    heapq.heappush(heap, (-whole, start, made, score + behind, ((start, at, i), path)))
        return out

    def _grow_trie(self) -> None:
        """The beginnings of pieces as arrays: (node, character) pairs in order, their nodes, and the score and id of each node's piece (id -1: none)."""
        node_of = {p: i + 1 for i, p in enumerate(sorted(self.prefixes))}
        alphabet = sorted({p[-1] for p in node_of})
        self.sign = np.zeros(0x110000, np.int32)  # characters in no piece: 0
        self.sign[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.signs = len(alphabet) + 1
        keys = np.array([node_of.get(p[:-1], 0) * self.signs + self.sign[ord(p[-1])] for p in node_of], np.int64)
        order = np.argsort(keys)
        self.keys, self.nodes = np.r_[keys[order], np.iinfo(np.int64).max], np.r_[np.fromiter(node_of.values(), np.int64)[order], 0]
        found = [self.prefixes[p] or (0.0, -1) for p in node_of]
        self.node_score, self.node_id = np.array([0.0, *(x for x, _ in found)]), np.array([-1, *(i for _, i in found)], np.int64)

    def _child(self, node: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """The nodes below, 0 where there is none."""
        want = node * self.signs + sign
        at = np.searchsorted(self.keys, want)
        return np.where((self.keys[at] == want) & (sign > 0), self.nodes[at], 0)

    def best_of_all(self, words: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of words of ``size`` characters each: best score, loss of the second best, number of ids and joined ids of the best path, and whether the heap must decide (then the rest means nothing)."""
        signs = self.sign[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")].reshape(-1, size).T
        # edges[k - 1][start]: the score of the piece of k characters there; pieces[k - 1][start]: its id
        node = self._child(np.zeros(signs.shape, np.int64), signs)
        edges, pieces_ = [np.where(self.node_id[node] >= 0, self.node_score[node], self.lowest)], [self.node_id[node]]
        while node.shape[0] > 1:
            k = len(edges) + 1
            at, word = np.nonzero(node[:-1])
            if not len(at):
                break
            found = self._child(node[at, word], signs[at + k - 1, word])
            node = np.zeros((size - k + 1, len(words)), np.int64)
            node[at, word] = found
            ids = self.node_id[node]
            edges.append(np.where(ids >= 0, self.node_score[node], _NONE))
            pieces_.append(ids)
        best = np.zeros((size + 1, len(words)))
        for end in range(1, size + 1):
            np.copyto(best[end], best[end - 1] + edges[0][end - 1])
            for k in range(2, min(end, len(edges)) + 1):
                np.maximum(best[end], best[end - k] + edges[k - 1][end - k], out=best[end])
        top = best[size]
        loss, doubt, n = np.full(len(words), np.inf), np.zeros(len(words), bool), np.zeros(len(words), np.int64)
        slack, taken = 1e-6 + 1e-9 * np.abs(top), []
        live, at, behind = np.arange(len(words)), np.full(len(words), size), np.zeros(len(words))
        while len(live):
            reach = best[at, live]
            whole, lost = np.full((len(edges), len(live)), _NONE), np.full((len(edges), len(live)), np.inf)
            for k in range(1, min(len(edges), size) + 1):
                ok = np.flatnonzero(at >= k)
                start, w = at[ok] - k, live[ok]
                score = edges[k - 1][start, w]
                whole[k - 1, ok] = best[start, w] + score + behind[ok]
                lost[k - 1, ok] = reach[ok] - best[start, w] - score
            chosen = whole.argmax(axis=0)
            column = np.arange(len(live))
            doubt[live] |= (whole >= whole[chosen, column] - slack[live]).sum(axis=0) > 1
            lost[chosen, column] = np.inf
            loss[live] = np.minimum(loss[live], lost.min(axis=0))
            ids = np.full(len(live), -1)
            at = at - chosen - 1
            for k in np.unique(chosen).tolist():
                ok = chosen == k
                ids[ok] = pieces_[k][at[ok], live[ok]]
                behind[ok] = edges[k][at[ok], live[ok]] + behind[ok]
            doubt[live] |= ids < 0
            n[live] += 1
            taken.append((live, ids))
            more = at > 0
            live, at, behind = live[more], at[more], behind[more]
        of, ids = np.concatenate([x for x, _ in taken[::-1]]), np.concatenate([x for _, x in taken[::-1]])
        return top, loss, n, ids[np.argsort(of, kind="stable")].astype("<u4"), doubt

    def ids_of(self, word: str, steps: list[tuple[int, int, int]]) -> list[int]:
        return [x for start, end, i in steps for x in ([i] if i >= 0 else self.spell(word[start:end]))]

    def n_best(self, word: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a word, best first, as ids."""
        return [(score, self.ids_of(word, steps)) for score, steps in self.search(*self.lattice(word), n)]

    def spell(self, character: str) -> list[int]:
        raw = character.encode()
        return [self.byte[b] for b in raw] if all(b in self.byte for b in raw) else [self.unknown]

    def _word(self, word: str) -> tuple[float, float, bytes]:
        """(best score, loss of the second best, best ids as bytes)."""
        best, into = self.lattice(word)
        steps = self.search(best, into, 1)[0][1]
        # every other path leaves the best one at some position, by another edge into it
        loss = min([best[end] - best[a] - x for start, end, _ in steps for a, x, _ in into[end] if a != start], default=float("inf"))
        ids = self.ids_of(word, steps)
        return best[-1], loss, struct.pack(f"<{len(ids)}I", *ids)

    def _detours(self, word: str, n: int) -> list[tuple[float, bytes]]:
        """(loss against the best, ids as bytes) of the n best segmentations of a word."""
        if (word, n) not in self.opened:
            found = self.n_best(word, n)
            self.opened[word, n] = [(found[0][0] - s, struct.pack(f"<{len(ids)}I", *ids)) for s, ids in found]
        return self.opened[word, n]

    def encode(self, text: str | None, n: int = NBEST) -> tuple[bytes, list[float]]:
        """Ids of the best segmentation (little-endian unsigned 32-bit) and the scores of the n best."""
        made, scores = self.encode_all(text, n)
        return made[0], scores

    def encode_all(self, text: str | None, n: int = NBEST) -> tuple[list[bytes], list[float]]:
        """Ids (little-endian unsigned 32-bit) and scores of the n best segmentations, best first."""
        return self.encode_batch([text], n)[0]

    def encode_batch(self, texts: list[str | None], n: int = NBEST) -> list[tuple[list[bytes], list[float]]]:
        """encode_all of each text."""
        chains = [self.chain(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        flat = [*chain.from_iterable(chains)]
        self.learn(set(flat).difference(self.words))
        where = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        loss, best, out, start = self.loss[where], self.best[where], [], 0
        ids = [*map(self.ids.__getitem__, where.tolist())]
        for words in chains:
            end = start + len(words)
            out.append(self._n_best_of(words, ids[start:end], loss[start:end], float(best[start:end].sum()), n) if words else ([b""], [0.0]))
            start = end
        return out

    def _n_best_of(self, words: list[str], ids: list[bytes], losses: np.ndarray, total: float, n: int) -> tuple[list[bytes], list[float]]:
        # n - 1 detours at most differ from the best path, so only the n - 1 words with the least losses matter
        few = np.flatnonzero(losses < float("inf")) if n > 1 else losses[:0].astype(int)
        if len(few) >= n:
            few = few[losses[few] <= np.partition(losses[few], n - 2)[n - 2]]
            few = np.sort(few[np.argsort(losses[few], kind="stable")][: n - 1])
        opened = [self._detours(words[i], n) for i in few]
        found = [(0.0, ())]  # loss against the best, and which path of each opened word
        for own in opened:
            found = heapq.nsmallest(n, ((a + b, (*taken, k)) for k, (b, _) in enumerate(own) for a, taken in found), key=lambda x: x[0])
        bounds = [-1, *few.tolist(), len(ids)]
        parts = [b"".join(ids[i + 1 : j]) for i, j in zip(bounds, bounds[1:])]
        made = [b"".join([parts[0], *(x for own, k, part in zip(opened, taken, parts[1:]) for x in (own[k][1], part))]) for _, taken in found]
        return made, [total - x for x, _ in found]

    def learn(self, words: set[str]) -> None:
        """Look up words that are new, those of one length together."""
        by_size: dict[int, list[str]] = {}
        for w in words:
            by_size.setdefault(len(w), []).append(w)
        for size, new in by_size.items():
            for i in range(0, len(new), 16_384):
                part = new[i : i + 16_384]
                if size > LONG_WORD:
                    self._hold(part, *zip(*map(self._word, part)))
                    continue
                best, loss, n, ids, doubt = self.best_of_all(part, size)
                raw, ends = ids.tobytes(), (4 * np.cumsum(n)).tolist()
                made = [raw[x:y] for x, y in zip([0, *ends], ends)]
                for j in np.flatnonzero(doubt):
                    best[j], loss[j], made[j] = self._word(part[j])
                self._hold(part, best, loss, made)

    def _hold(self, words: list[str], best, loss, ids) -> None:
        at, end = len(self.ids), len(self.ids) + len(words)
        if end > len(self.best):
            self.best, self.loss = (np.concatenate([x, np.zeros(max(end, 4096))]) for x in (self.best, self.loss))
        self.best[at:end], self.loss[at:end] = best, loss
        self.ids.extend(ids)
        self.words.update(zip(words, range(at, end)))

    def forget(self) -> None:
        """Empty the cache, short words (which come back most) aside, once it is full."""
        if len(self.opened) > CACHE_WORDS // 8:
            self.opened = {}
        if len(self.words) > CACHE_WORDS:
            short = [(w, i) for w, i in self.words.items() if len(w) < 8]
            short = short if len(short) < CACHE_WORDS // 2 else []
            at = [i for _, i in short]
            self.words = {w: n for n, (w, _) in enumerate(short)}
            self.best, self.loss, self.ids = self.best[at], self.loss[at], [self.ids[i] for i in at]

    def encode_n(self, text: str, n: int = NBEST) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a whole text by one search over its lattice."""
        return self.n_best(MARK + text.replace(" ", MARK), n) if text else [(0.0, [])]

    def decode(self, ids: np.ndarray | list[int]) -> str:
        return self.decode_all([np.asarray(ids, np.int64)])[0]

    def decode_all(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of several lists of ids: their pieces' bytes are gathered from one table."""
        table, first, size = self._bytes
        joined = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        n = size[joined]
        ends = np.cumsum(n)
        raw = table[np.repeat(first[joined] - ends + n, n) + np.arange(n.sum())].tobytes()
        cuts = np.r_[0, ends][np.cumsum([0, *map(len, ids)])].tolist()
        return [raw[a:b].decode("utf-8", "replace").replace(MARK, " ")[1:] for a, b in zip(cuts, cuts[1:])]

    @cached_property
    def _bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all pieces, and where each piece's begin and how many they are."""
        spelled = [bytes([self.byte_of[i]]) if i in self.byte_of else p.encode() for i, p in enumerate(self.text)]
        size = np.array([*map(len, spelled)])
        return np.frombuffer(b"".join(spelled), np.uint8), np.cumsum(size) - size, size


@lru_cache(maxsize=2)
def pieces(model: str) -> Pieces:
    return Pieces(model)


def encode(docs: DataFrame, model: str, n: int = NBEST) -> DataFrame:
    """doc_id, ids (array<int>) of the best segmentation, scores and n_best_ids of the n best (best first) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in batches:
            for i in range(0, len(b), 256):
                part = b.slice(i, 256)
                p.forget()
                got = p.encode_batch(part.column("text").to_pylist(), n)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists([x[0] for x, _ in got]), pa.array([s for _, s in got], pa.list_(pa.float64())), nested([x for x, _ in got])], names=["doc_id", "ids", "scores", "n_best_ids"])

    def lists(made: list[bytes]) -> pa.ListArray:
        lengths = np.array([0, *(len(x) // 4 for x in made)]).cumsum()
        return pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.frombuffer(b"".join(made), "<i4")))

    def nested(made: list[list[bytes]]) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.array([0, *map(len, made)]).cumsum(), pa.int32()), lists([x for own in made for x in own]))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>, scores array<double>, n_best_ids array<array<int>>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of encoded(doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in batches:
            for i in range(0, len(b), 256):
                part = b.slice(i, 256)
                ids = part.column("ids")
                lists = [ids[j].values.to_numpy() if ids[j].is_valid else np.zeros(0, np.int32) for j in range(len(part))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p.decode_all(lists), pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str, n: int = NBEST) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, best_score, n_best_scores, text_crc32, decoded_crc32 (of the text that the ids decode to) and n_best_crc32 (of the ids of each of the n best) of every document: what encode and decode give, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in batches:
            rows = []
            for i in range(0, len(b), 256):
                p.forget()
                texts = b.column("text").slice(i, 256).to_pylist()
                got = p.encode_batch(texts, n)
                back = p.decode_all([np.frombuffer(made[0], "<u4") for made, _ in got])
                for t, (made, scores), x in zip(texts, got, back):
                    rows.append((len(made[0]) // 4, zlib.crc32(made[0]), scores[0], scores, zlib.crc32((t or "").encode()), zlib.crc32(x.encode()), [*map(zlib.crc32, made)]))
            cols = [*zip(*rows)] or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["doc_id", "n_pieces", "ids_crc32", "best_score", "n_best_scores", "text_crc32", "decoded_crc32", "n_best_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, best_score double, n_best_scores array<double>, text_crc32 long, decoded_crc32 long, n_best_crc32 array<long>")
