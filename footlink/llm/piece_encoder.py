"""SentencePiece BPE encoding through a prefix table, and decoding.

For every prefix of a text, BPE has exactly one last token. An automaton
finds all vocabulary pieces that end at a position; the one that may follow
the last token of the prefix before it is that position's entry. Whether two
tokens may stand side by side is decided by merging their joined text alone:
they are compatible when that gives the two tokens back. The ids come from
walking the table back from the end.

Merging is the library's: of all neighbours whose joined text is a normal
piece, the highest score goes first, the leftmost on ties. Pieces that their
own text does not merge into are never tokens. A character outside the
vocabulary becomes its UTF-8 byte pieces.

A text is cut into runs wherever two neighbouring characters stand side by
side in no piece (before most space marks, for one): no token crosses such a
place. The distinct runs of a chunk of text share one prefix table: the
automaton, a trie of the pieces read backwards, steps through all of them at
once, and pair tests are remembered.

The model is read once on the driver (``vocabulary``: pieces, scores, kinds;
a fixed-size file) and broadcast. The model must have identity
normalisation, a dummy prefix and byte pieces; ``vocabulary`` checks this.

Edge cases: null and empty texts have no ids and decode to an empty text;
repeated rows are encoded alike; extra columns are carried by ``encode``, but
for any called ids or decoded, which its own replace.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlink.llm import text as T
from footlink.llm.frames import release, table

MARK = "▁"
MODEL = "piece_bpe_32k.model"
CHUNK = 1 << 20
BLOCK = 8192
AREA = 1 << 20
MEMO_RUNS = 120_000
MEMO_LENGTH = 64


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(MODEL)


def vocabulary(path: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id; kind is normal, byte or other."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        kind = ("byte" if model.is_byte(i) else
                "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal")
        out.append((model.id_to_piece(i), model.get_score(i), kind))
    probe = " a\n\t ﬁ  b"
    if sum(k == "byte" for _, _, k in out) != 256 or model.decode(model.encode(probe)) != probe:
        raise ValueError(f"{path}: needs byte pieces and identity normalisation")
    return out


class Encoder:
    """Prefix-table encoder for one vocabulary (built once per worker)."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.id_of = {p: i for i, (p, _, k) in enumerate(pieces) if k == "normal"}
        self.score = [s for _, s, _ in pieces]
        self.text_of = [p for p, _, _ in pieces]
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == "byte"}
        surface = [bytes([int(p[3:5], 16)]) if k == "byte" else
                   p.replace(MARK, " ").encode() if k == "normal" else b"" for p, _, k in pieces]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_len = np.array([len(s) for s in surface])
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        # Characters of the vocabulary are numbered from 1; 0 is any other.
        chars = sorted({c for p in self.id_of for c in p})
        self.number = np.zeros(0x110000, np.int32)
        self.number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.width = len(chars) + 1
        self.beside = np.zeros((self.width, self.width), bool)    # neighbours within some piece
        for p in self.id_of:
            for b, c in pairwise(p):
                self.beside[self.number[ord(b)], self.number[ord(c)]] = True
        self.codes = np.random.default_rng(0x5E9).integers(1, 1 << 63, self.width, dtype=np.uint64) | T.U64(1)
        self.edges: dict[int, list[tuple[float, str, str]]] = {}   # merges of the tokens met so far
        node: dict[int, int] = {}                       # automaton: (state, character) -> state, pieces read backwards
        self.token = [-1]
        for p, i in self.id_of.items():
            if self._merges(p) is None:
                continue
            at = 0
            for c in reversed(p):
                at = node.setdefault(at * self.width + int(self.number[ord(c)]), len(self.token))
                if at == len(self.token):
                    self.token.append(-1)
            self.token[at] = i
        self.token = np.array(self.token, np.int32)
        self.steps = _Table(np.array(list(node), np.int64), np.array(list(node.values()), np.int32))
        self.root = self.steps.get(np.arange(self.width, dtype=np.int64))
        self.memo: dict[str, bytes] = {}                 # ids of short runs seen lately
        self.known_key = np.full(1 << 20, -1, np.int64)  # pairs tested so far, the latest in each place
        self.known_fit = np.zeros(1 << 20, bool)

    def _merges(self, text: str) -> list[tuple[float, str, str]] | None:
        """Plain BPE of one piece: the score of each merge in turn and the
        first and last part before it; None if the piece does not come out."""
        parts, steps = list(text), []
        while len(parts) > 1:
            best, at = None, -1
            for i, (a, b) in enumerate(pairwise(parts)):
                j = self.id_of.get(a + b)
                if j is not None and (best is None or self.score[j] > best):
                    best, at = self.score[j], i
            if best is None:
                return None
            steps.append((best, parts[0], parts[-1]))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return steps

    def compatible(self, a: int, b: int) -> bool:
        """Do a and b stay two tokens when they stand side by side? Their
        own merges run in order of score, and at each moment the parts that
        meet between them must not be the best pair to merge. On equal scores
        the leftmost pair goes first: one inside a before the pair between,
        that before one inside b."""
        for token in (a, b):
            if token not in self.edges:
                self.edges[token] = self._merges(self.text_of[token])
        ours, theirs, never = self.edges[a], self.edges[b], float("-inf")
        i = j = 0
        while True:
            ours_next, x = (ours[i][0], ours[i][2]) if i < len(ours) else (never, self.text_of[a])
            theirs_next, y = (theirs[j][0], theirs[j][1]) if j < len(theirs) else (never, self.text_of[b])
            between = self.id_of.get(x + y)
            if between is not None and self.score[between] > ours_next and self.score[between] >= theirs_next:
                return False
            if ours_next == theirs_next == never:
                return True
            if ours_next >= theirs_next:
                i += 1
            else:
                j += 1

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``compatible`` for arrays, remembering pairs."""
        key = left.astype(np.int64) * len(self.score) + right
        at = (T.mix(key.view(np.uint64)) >> T.U64(44)).astype(np.int64)
        out = self.known_fit[at]
        new = np.flatnonzero(self.known_key[at] != key)
        if len(new):
            fresh, inverse = np.unique(key[new], return_inverse=True)
            fit = np.array([self.compatible(*divmod(k, len(self.score))) for k in fresh.tolist()])
            out[new] = fit[inverse]
            self.known_key[at[new]], self.known_fit[at[new]] = key[new], out[new]
        return out

    def _tables(self, chars: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prefix tables of many runs side by side, longest run first: ids of
        all runs one after the other, and their counts."""
        n, longest = len(start), int(length[0])
        last = np.full((n, longest + 1), -1, np.int32)    # the unique last token of each prefix
        size = np.zeros((n, longest + 1), np.int32)
        for end in range(1, longest + 1):
            at = np.arange(int(np.searchsorted(-length, -end, "right")))
            for back in range(1, end + 1):
                char = chars[start[at] + end - back]
                state = self.root[char] if back == 1 else self.steps.get(state.astype(np.int64) * self.width + char)
                alive = state > 0
                at, state = at[alive], state[alive]
                if not len(at):
                    break
                token = self.token[state]
                some = np.flatnonzero((token >= 0) & (size[at, end] == 0))
                if len(some) and back < end:
                    some = some[self.fits(last[at[some], end - back], token[some])]
                last[at[some], end] = token[some]
                size[at[some], end] = back
        steps, at, where = [], np.arange(n), length.astype(np.int64)
        while len(at):                                    # backwards from the end of each run
            steps.append((at, last[at, where]))
            where = where - size[at, where]
            at, where = at[where > 0], where[where > 0]
        run = np.concatenate([a for a, _ in steps])
        ids = np.concatenate([t for _, t in steps])
        depth = np.repeat(np.arange(len(steps)), [len(a) for a, _ in steps])
        return ids[np.lexsort((-depth, run))], np.bincount(run, minlength=n)

    def _distinct(self, chars: np.ndarray, points: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Index of the first equal run for each run (by hash, then checked
        character by character)."""
        h = T.run_hashes(chars, start, end, self.codes)
        other = chars[start] == 0                         # one character outside the vocabulary
        h[other] = T.mix(points[start[other]].astype(T.U64) + T.U64(1 << 40))
        _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        twin, length = first[inverse], end - start
        same = np.array_equal(length, length[twin])
        if same:
            shift = np.repeat(start[twin] - start, length)
            at = np.arange(len(points))
            same = np.array_equal(points[at], points[at + shift])
        return (first, inverse) if same else (np.arange(len(start)), np.arange(len(start)))

    def _recall(self, text: str, chars: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[bytes]:
        """Packed ids of each distinct run, from the memo or a new table."""
        runs = [text[a:a + n] for a, n in zip(start.tolist(), length.tolist(), strict=True)]
        found = [self.memo.get(r) for r in runs]
        new = np.array([i for i, f in enumerate(found) if f is None], np.int64)
        for i in new[chars[start[new]] == 0].tolist():    # outside the vocabulary
            found[i] = np.array([self.byte_id[b] for b in runs[i].encode()], np.int32).tobytes()
        new = new[chars[start[new]] > 0]
        new = new[np.argsort(-length[new], kind="stable")]
        lo = 0
        while lo < len(new):                              # tables of at most AREA entries (or one run)
            some = new[lo:lo + max(1, min(BLOCK, AREA // int(length[new[lo]])))]
            lo += len(some)
            ids, n = self._tables(chars, start[some], length[some])
            packed, ends = ids.tobytes(), np.cumsum(n) * 4
            for i, a, b in zip(some.tolist(), (ends - 4 * n).tolist(), ends.tolist(), strict=True):
                found[i] = packed[a:b]
                if length[i] <= MEMO_LENGTH:
                    self.memo[runs[i]] = found[i]
        if len(self.memo) > MEMO_RUNS:
            self.memo.clear()
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and each text's count."""
        marked = [MARK + t if t else "" for t in texts]
        text = "".join(marked).replace(" ", MARK)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in marked], out=bounds[1:])
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        chars = self.number[points]
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.beside[chars[:-1], chars[1:]]
        cut[bounds[:-1][np.diff(bounds) > 0]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(points))
        first, inverse = self._distinct(chars, points, start, end)
        s, length = start[first], (end - start)[first]
        found = self._recall(text, chars, s, length)
        counts = np.array([len(f) // 4 for f in found], np.int64)
        at = np.cumsum(counts) - counts
        ids = _gather(np.frombuffer(b"".join(found), np.int32), at[inverse], counts[inverse])
        total = np.zeros(len(start) + 1, np.int64)
        np.cumsum(counts[inverse], out=total[1:])
        run_of = np.searchsorted(start, bounds)
        return ids, np.diff(total[run_of])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """UTF-8 of all texts one after the other, and each text's length;
        the space of the dummy prefix goes."""
        at, length = self.surface_at[ids], self.surface_len[ids]
        head = (np.cumsum(counts) - counts)[counts > 0]
        head = head[(length[head] > 0) & (self.surface[at[head]] == 0x20)]
        at[head] += 1
        length[head] -= 1
        total = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(length, out=total[1:])
        ends = np.cumsum(counts)
        return _gather(self.surface, at, length).tobytes(), total[ends] - total[ends - counts]


def _gather(values: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The slices ``values[at:at + length]`` one after the other."""
    before = np.cumsum(length) - length
    return values[np.repeat(at - before, length) + np.arange(int(length.sum()))]


class _Table:
    """Fixed map from long to int for whole arrays: four places a bucket."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits, self.salt = max(4, int(len(keys) * 4).bit_length()), 0
        while True:
            at = self._bucket(keys)
            order = np.argsort(at, kind="stable")
            first = np.searchsorted(at[order], at[order])
            place = np.arange(len(keys)) - first
            if place.max(initial=0) < 4:
                break
            self.salt += 1
        self.keys = np.full((1 << self.bits, 4), -1, np.int64)
        self.values = np.zeros((1 << self.bits, 4), np.int32)
        self.keys[at[order], place] = keys[order]
        self.values[at[order], place] = values[order]

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        mixed = T.mix(keys.view(np.uint64) + T.U64(self.salt * 2 + 1))
        return (mixed >> T.U64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys; 0 where there is none."""
        at = self._bucket(keys)
        return np.where(self.keys[at] == keys[:, None], self.values[at], 0).sum(axis=1, dtype=np.int32)


_BUILT: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per worker and vocabulary."""
    key = hash(tuple(shared.value))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Encoder(shared.value)
    return _BUILT[key]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``decoded`` in place of the
    text. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path or model_path()))
    docs = docs.drop("ids", "decoded")
    keep = [c for c in docs.columns if c != "text"]

    def of(batches):
        model = _encoder(shared)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for lo, hi, buf, bounds in T.text_chunks(batch.column(at), CHUNK):
                raw = buf.tobytes()
                ids, counts = model.encode([raw[a:b].decode("utf-8", "replace") for a, b in pairwise(bounds.tolist())])
                back, lengths = model.decode(ids, counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns) if i != at]
                    + [pa.ListArray.from_arrays(_offsets(counts), pa.array(ids)),
                       pa.StringArray.from_buffers(hi - lo, _offsets(lengths).buffers()[1], pa.py_buffer(back))],
                    names=[*[n for n in batch.schema.names if n != "text"], "ids", "decoded"])
            release()

    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != "text")
    return docs.select(*keep, "text").mapInArrow(of, f"{types}ids array<int>, decoded string")


def _offsets(counts: np.ndarray) -> pa.Array:
    out = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=out[1:])
    return pa.array(out)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    return encode(docs.select("doc_id", "text"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
