"""Order-preserving packing of token streams by dynamic programming.

Every partition of the input is a stream: its documents, in the order in which they come, tokenised, each with the
end id behind.  The stream is cut into windows of at most ``window`` tokens.  A cut costs nothing at a document's
end, little at a sentence's end and more inside a sentence (a truncation); a window costs its padding and a fixed
amount for being opened.  Windows are padded to the full length, except those whose length is a power of two.  The
cheapest cuts up to position j come from those up to an earlier i: a queue kept monotone in cost(i) + i gives the
best i of the last ``window`` tokens, and the power-of-two lengths are looked up.  No shuffle: a task reads its
partition once, holds GROUP tokens, and carries what follows the last settled cut into the next group.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pradera.session import ship_package

WINDOW = 2048
END_ID = 1
GROUP = 1 << 19           # tokens per run of the dynamic programme
OPEN_COST = 32.0          # of each window
SENTENCE_COST = 1.0       # cut between sentences of a document
TRUNCATION_COST = 16.0    # cut inside a sentence
GRAIN = 32                # inside long sentences, a cut is possible after so many tokens
CHUNK = 1 << 20           # characters tokenised at a time
BLANKS = 1 << 16          # white space in a row, from which tiktoken's pattern would need too deep a stack
_SPACE = re.compile(r"\s+")
_SAFE = re.compile(r"[A-Za-z](?= [A-Za-z])")  # a pre-token ends here, whatever follows


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable bytes are themselves, others 256 and on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed: byte-level BPE


@dataclass(frozen=True)
class Vocabulary:
    """What tasks need of a tokenizer file."""

    key: str
    ranks: dict | None     # bytes -> id where ids follow the merges, else None
    special: dict          # text -> id
    ends: bytes            # for each id, 1 if a sentence may end with it
    spec: str              # the file, for texts that the library has to run


def vocabulary(spec: str) -> Vocabulary:
    """Read a ``tokenizers`` file.

    Where it is a plain byte-level BPE whose ids follow its merges, tiktoken's merge loop gives the same ids in a third
    of the time; other files are run by ``tokenizers`` itself.
    """
    d = json.loads(spec)
    letters, vocab, added = _byte_letters(), d["model"].get("vocab", {}), d.get("added_tokens", [])
    special = {x["content"]: x["id"] for x in added}
    pre = d.get("pre_tokenizer") or {}
    merges = [x if isinstance(x, list) else x.split(" ") for x in d["model"].get("merges", [])]
    plain = (d["model"].get("type") == "BPE" and pre.get("type") == "ByteLevel" and not d.get("normalizer")
             and not pre.get("add_prefix_space") and pre.get("use_regex", True)
             and all(x.get("special") and not (x["lstrip"] or x["rstrip"] or x["single_word"]) for x in added)
             and [vocab.get(a + b) for a, b in merges] == list(range(256, 256 + len(merges))))
    ranks = {bytes(letters[c] for c in w): i for w, i in vocab.items() if w not in special} if plain else {}
    plain = plain and sorted(ranks.values()) == list(range(256 + len(merges)))
    size = max([*vocab.values(), *special.values()], default=-1) + 1
    if plain:
        text = {i: b.decode("utf-8", "replace") for b, i in ranks.items()} | {i: x for x, i in special.items()}
        words = [text.get(i, "") for i in range(size)]
    else:
        from tokenizers import Tokenizer
        whole = Tokenizer.from_str(spec)
        words = [whole.decode([i], skip_special_tokens=False) for i in range(size)]
    # a sentence may end with an id whose text ends with a stop or holds a line end
    ends = bytes(bool(re.search(r"[.!?…。！？][\"')\]»”]*\s*$|\n", w)) for w in words)
    return Vocabulary(hashlib.md5(spec.encode()).hexdigest(), ranks if plain else None, special, ends, spec)


class Encoder:
    """Ids that ``tokenizers`` gives with a vocabulary, without added special tokens."""

    def __init__(self, v: Vocabulary):
        self.special, self.fast, self.slow, self.spec = list(v.special), None, None, v.spec
        if v.ranks is not None:
            import tiktoken
            self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=v.ranks,
                                          special_tokens=v.special)

    def _library(self, text: str) -> list[int]:
        if self.slow is None:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_str(self.spec)
        return self.slow.encode(text, add_special_tokens=False).ids

    def _encode(self, text: str) -> list[int]:
        if self.fast is None:
            return self._library(text)
        if any(s in text for s in self.special):
            return self.fast.encode(text, allowed_special="all")
        return self.fast.encode_ordinary(text)

    def __call__(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a whole text, in parts that end where a pre-token surely ends."""
        at = 0
        if len(text) > BLANKS and any(m.end() - m.start() > BLANKS for m in _SPACE.finditer(text)):
            yield np.array(self._library(text), dtype=np.uint32)
            return
        while at < len(text) or not at:
            end = len(text)
            if self.fast is not None and end - at > CHUNK and (m := _SAFE.search(text, at + CHUNK)):
                end = m.end()
            yield np.array(self._encode(text[at:end]), dtype=np.uint32)
            at = end or 1


_encoders: dict[str, Encoder] = {}  # of a worker


def _encoder(v: Vocabulary) -> Encoder:
    if v.key not in _encoders:
        _encoders.clear()
        _encoders[v.key] = Encoder(v)
    return _encoders[v.key]


def padding(length, window: int = WINDOW):
    """Padding of sequences by length: up to the window, none at powers of two."""
    n = np.asarray(length)
    return np.where((n & (n - 1)) == 0, 0, window - n)


def candidates(n: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int, last: bool):
    """Positions where a window may end, ascending from 0, and what each cut costs.

    Documents' and sentences' ends; inside longer gaps every GRAIN tokens; at the end of the stream every position of
    the last window, so that what is left can be dealt to powers of two.
    """
    is_cut = np.zeros(n + 1, dtype=bool)
    is_cut[sentence_ends] = is_cut[doc_ends] = is_cut[0] = is_cut[n] = True
    ends = np.flatnonzero(is_cut)
    grain = min(GRAIN, window)
    extra = np.maximum(0, (np.diff(ends) - 1) // grain)
    base = np.repeat(ends[:-1], extra)
    step = np.arange(len(base)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    is_cut[base + step * grain] = True
    if last:
        is_cut[max(0, n - window):] = True
    cost = np.full(n + 1, TRUNCATION_COST)
    cost[sentence_ends] = SENTENCE_COST
    cost[doc_ends] = cost[0] = 0.0
    if last:
        cost[n] = 0.0
    pos = np.flatnonzero(is_cut)
    return pos, cost[pos]


def best_cuts(pos: np.ndarray, cut_cost: np.ndarray, window: int = WINDOW, last: bool = True) -> np.ndarray:
    """Ends of the cheapest windows over candidate positions (pos[0] = 0; gaps at most ``window``).

    With ``last`` the windows reach the last position, else the cheapest position within the last window of it.
    """
    n = len(pos)
    powers = [1 << k for k in range(window.bit_length()) if 1 << k < window]
    place = np.full(int(pos[-1]) + 1, -1)
    place[pos] = np.arange(n)
    pairs = []
    for p in powers:  # i, j with pos[j] - pos[i] a power of two
        j = np.arange(int(np.searchsorted(pos, p)), n)
        i = place[pos[j] - p]
        pairs.append(np.c_[j, i][i >= 0])
    pairs = np.concatenate(pairs) if pairs else np.zeros((0, 2), dtype=int)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    first = np.searchsorted(pairs[:, 0], np.arange(n + 1)).tolist()
    by_power = pairs[:, 1].tolist()
    x, fixed = pos.tolist(), (OPEN_COST + window - pos + cut_cost).tolist()
    exact = (OPEN_COST + cut_cost).tolist()
    f, back = [0.0] * n, [0] * n
    queue = deque([(0.0, 0, 0)])  # (cost + position, position, index), ascending
    for j in range(1, n):
        low = x[j] - window
        while queue[0][1] < low:
            queue.popleft()
        key, _, i = queue[0]
        best = key + fixed[j]
        for k in range(first[j], first[j + 1]):
            other = f[by_power[k]] + exact[j]
            if other < best:
                best, i = other, by_power[k]
        f[j], back[j] = best, i
        key = best + x[j]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, x[j], j))
    j = n - 1
    if not last:
        tail = range(int(np.searchsorted(pos, pos[-1] - window, side="right")), n)
        j = min(tail, key=lambda t: (f[t], -t))
    ends = []
    while j > 0:
        ends.append(x[j])
        j = back[j]
    return np.array(ends[::-1], dtype=np.int64)


class _Stream:
    """Tokens of a partition that are not yet in a settled window, with the document parts that they belong to."""

    def __init__(self, window: int, ends: np.ndarray, task: int):
        self.window, self.is_end, self.next_id = window, ends, task << 32
        self.ids, self.parts, self.size = [], [], 0  # parts: (document, start in it, length, ends the document)

    def add(self, doc, start: int, ids: np.ndarray, ends_doc: bool):
        self.ids.append(ids)
        if self.parts and self.parts[-1][0] == doc:  # goes on with the same document
            _, start, n, _ = self.parts.pop()
            self.parts.append((doc, start, n + len(ids), ends_doc))
        else:
            self.parts.append((doc, start, len(ids), ends_doc))
        self.size += len(ids)

    def settle(self, last: bool):
        """Pieces (document, start, ids, sequence, offset) of the windows that are settled; the rest stays."""
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.uint32)
        if not len(ids):
            return []
        length = np.array([p[2] for p in self.parts])
        part_end = np.cumsum(length)
        doc_ends = part_end[[p[3] for p in self.parts]]
        pos, cost = candidates(len(ids), doc_ends, np.flatnonzero(self.is_end[ids]) + 1, self.window, last)
        ends = best_cuts(pos, cost, self.window, last)
        to = int(ends[-1])
        cuts = np.union1d(ends, part_end[part_end <= to])
        begin = np.r_[0, cuts[:-1]]
        window = np.searchsorted(ends, begin, side="right")
        part = np.searchsorted(part_end, begin, side="right")
        window_start = np.r_[0, ends][window]
        out = []
        for a, b, w, p, s in zip(begin.tolist(), cuts.tolist(), window.tolist(), part.tolist(), window_start.tolist(),
                                 strict=True):
            doc, start, n, _ = self.parts[p]
            out.append((doc, start + a - (int(part_end[p]) - n), ids[a:b], self.next_id + w, a - s))
        self.next_id += len(ends)
        k = int(np.searchsorted(part_end, to, side="right"))
        rest = self.parts[k:]
        if rest:
            doc, start, n, fin = rest[0]
            gone = n - (int(part_end[k]) - to)
            rest[0] = (doc, start + gone, n - gone, fin)
        self.parts, self.ids, self.size = rest, [ids[to:].copy()], len(ids) - to
        return out


def _pack_partition(batches, v: Vocabulary, end_id: int, window: int, id_type: pa.DataType, task: int):
    encode = _encoder(v)
    is_end = np.zeros(max(len(v.ends), end_id + 1), dtype=bool)
    is_end[:len(v.ends)] = np.frombuffer(v.ends, dtype=bool)
    stream, totals, open_pieces = _Stream(window, is_end, task), {}, []
    known, row = {}, 0

    def settle(last):
        open_pieces.extend(stream.settle(last))
        ready = [p for p in open_pieces if p[0] in totals]  # a document's size is known when all of it is read
        open_pieces[:] = [p for p in open_pieces if p[0] not in totals]
        if not ready:
            return None
        out = pa.RecordBatch.from_arrays([
            pa.array([known[p[0]] for p in ready], type=id_type),
            pa.array([p[1] for p in ready], type=pa.int64()),
            pa.array([len(p[2]) for p in ready], type=pa.int64()),
            pa.array([p[2].astype("<u4").tobytes() for p in ready], type=pa.binary()),
            pa.array([totals[p[0]] for p in ready], type=pa.int64()),
            pa.array([p[3] for p in ready], type=pa.int64()),
            pa.array([p[4] for p in ready], type=pa.int64()),
        ], names=PIECES)
        live = {p[0] for p in stream.parts} | {p[0] for p in open_pieces}
        for d in [d for d in totals if d not in live]:
            del totals[d], known[d]
        return out

    for batch in batches:
        for doc_id, text, ends in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            known[row], start = doc_id, 0
            for ids in encode(text.as_py() or ""):
                for at in range(0, len(ids), GROUP):
                    part = ids[at:at + GROUP]
                    stream.add(row, start, part, False)
                    start += len(part)
                    if stream.size >= GROUP and (out := settle(False)) is not None:
                        yield out
            if ends:
                stream.add(row, start, np.array([end_id], dtype=np.uint32), True)
                start += 1
            totals[row] = start
            row += 1
    if (out := settle(True)) is not None:
        yield out


PIECES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, window: int = WINDOW,
         ends: Column | None = None) -> DataFrame:
    """One row per piece of a document in a sequence.

    ``doc_id``; ``start`` (ids of the document before the piece), ``length``, ``ids`` (binary, unsigned 32-bit little
    endian), ``doc_tokens`` (with the end id; only rows of which ``ends`` is true have one, all if it isn't given), ``sequence_id``, ``offset`` (in the sequence, gapless from 0).  A null
    or empty text is its end id alone.  Every row of ``docs`` is packed, repeated ones as often as they come; null ids
    stay null; other columns are not read.  A sequence holds tokens of one partition, in the order of its rows; an
    empty table has no piece.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        v = vocabulary(f.read())
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(v)  # as large as the vocabulary file

    def run(batches):
        yield from _pack_partition(batches, shared.value, end_id, window, id_type, TaskContext.get().partitionId())
    return docs.select("doc_id", "text", F.coalesce(F.lit(True) if ends is None else ends, F.lit(False))).mapInArrow(run, schema)
