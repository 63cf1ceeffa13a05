"""Token counts of whole texts: byte-pair merges on ragged numpy arrays, all pre-tokens of a batch in step.

The model is a sentencepiece BPE file whose normaliser is the identity: a text gets one leading space mark, spaces
become marks, and the mark starts a pre-token (no piece has a mark behind another character).  The distinct
pre-tokens of a batch lie end to end in one array; each round finds every sequence's best-ranked adjacent pair and
merges its occurrences at once, until no sequence has a pair.  Characters without a piece count as their bytes.

Marks that no word takes up form runs; their pieces all rank last and equal, so a run is merged by itself, leftmost
pair first.  Words of over LONG characters are merged one pair at a time from a heap: the same merges in n log n.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pradera.session import ship_package

MARK = "▁"
LIMIT = 4096
LONG = 256
CACHE_WORDS = 500_000     # pre-tokens a worker remembers; beyond that it starts anew
LONG_TEXT = 4_000_000      # characters split into words at a time
NONE = np.int32(2**31 - 1)
_SINGLE_SPACE = re.compile("[^ ] (?=[^ ])")


@dataclass
class Merges:
    """Merge table: symbols are characters and pieces, numbered; pairs map to the piece that they make."""

    char_code: np.ndarray          # sorted code points that occur in pieces
    char_symbol: np.ndarray
    pair_key: np.ndarray           # sorted left * 2**32 + right
    pair_symbol: np.ndarray
    pair_rank: np.ndarray          # smaller merges first
    cost: np.ndarray               # tokens that a symbol counts as
    runs: frozenset                # lengths of pieces that consist of marks
    words: dict = field(default_factory=dict)
    run_counts: dict = field(default_factory=dict)

    def __getstate__(self):
        drop = {"words": {}, "run_counts": {}, "_index": None, "_table": None}
        return {**self.__dict__, **drop}


def load(path: str) -> Merges:
    """Merge table of a sentencepiece BPE model file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)
    score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not special(i)}
    return from_scores(score)


def from_scores(score: dict[str, float]) -> Merges:
    runs = frozenset(len(p) for p in score if set(p) == {MARK})
    words = {p: s for p, s in score.items() if set(p) != {MARK} or len(p) == 1}
    if any(MARK in p[1:] for p in words):
        raise ValueError("a piece has a space mark behind another character")
    chars = sorted({c for p in words for c in p})
    symbol = {x: i for i, x in enumerate([*chars, *(p for p in words if len(p) > 1)])}
    order = {s: r for r, s in enumerate(sorted(set(words.values()), reverse=True))}
    pairs = sorted((symbol[p[:k]] << 32 | symbol[p[k:]], symbol[p], order[s])
                   for p, s in words.items() for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol)
    cost = np.array([1 if x in words else len(x.encode()) for x in symbol], dtype=np.int64)
    key, sym, rank = (np.array(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int),) * 3
    return Merges(np.array([ord(c) for c in chars], dtype=np.uint32), np.arange(len(chars), dtype=np.int32),
                  key.astype(np.int64), sym.astype(np.int32), rank.astype(np.int32), cost, runs)


def _symbols(text: str, m: Merges) -> np.ndarray:
    """Symbol of each character; characters of no piece: minus their bytes."""
    c = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    at = np.minimum(np.searchsorted(m.char_code, c), len(m.char_code) - 1)
    size = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
    return np.where(m.char_code[at] == c, m.char_symbol[at], -size).astype(np.int32)


def _slots(key: np.ndarray, mult: int, bits: int) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(mult)) >> np.uint64(64 - bits)).astype(np.int64)


def _pair_index(key: np.ndarray) -> list:
    """Two-choice hash index of the pair keys: levels of (multiplier, bits, slot -> place); later levels take the
    keys that collided, so a lookup is a few gathers in place of a binary search."""
    levels, rest, mult = [], np.arange(len(key)), 0x9E3779B97F4A7C15
    while len(rest):
        bits = max(8, int(np.ceil(np.log2(len(rest)))) + 2)
        at = _slots(key[rest], mult, bits)
        place = np.full(1 << bits, -1, dtype=np.int32)
        place[at[::-1]] = rest[::-1]  # the first of a slot stays
        levels.append((mult, bits, place))
        rest = rest[place[at] != rest]
        mult = (mult * 0xD1342543DE82EF95 + 1442695040888963407) % (1 << 64) | 1
    return levels


def _ranks(left: np.ndarray, right: np.ndarray, m: Merges):
    """Rank (NONE: no merge) and merged symbol of adjacent symbols."""
    index = m.__dict__.get("_index")
    if index is None:
        index = m.__dict__["_index"] = _pair_index(m.pair_key)
    rank = np.full(len(left), NONE, dtype=np.int32)
    made = np.zeros(len(left), dtype=np.int32)
    todo = np.flatnonzero((left >= 0) & (right >= 0))
    key = (left[todo].astype(np.int64) << 32) | right[todo]
    for mult, bits, place in index:
        at = place[_slots(key, mult, bits)]
        found = (at >= 0) & (m.pair_key[at] == key)
        rank[todo[found]], made[todo[found]] = m.pair_rank[at[found]], m.pair_symbol[at[found]]
        on = ~found & (at >= 0)  # an empty slot: no such pair
        todo, key = todo[on], key[on]
        if not len(todo):
            break
    return rank, made


def _apart(at: np.ndarray) -> np.ndarray:
    """Of picked pairs (their places, ascending) that overlap in a row, every other one, from the left."""
    near = np.diff(at) == 1
    if not near.any():
        return at
    order = np.arange(len(at))
    first = np.maximum.accumulate(np.where(np.r_[True, ~near], order, 0))
    return at[(order - first) % 2 == 0]


class _Ragged:
    """Sequences end to end: symbols, and of each symbol the rank and piece of the pair with the next one."""

    def __init__(self, sym, length, which, rank, made):
        self.sym, self.length, self.which, self.rank, self.made = sym, length, which, rank, made

    @classmethod
    def of(cls, sym, length, which, m):
        r = cls(sym, length, which, np.full(len(sym), NONE, dtype=np.int32), np.zeros(len(sym), dtype=np.int32))
        r.update(np.arange(len(sym)), m)
        return r

    def update(self, at, m):
        """Look the pairs at these places up again."""
        end = np.zeros(len(self.sym) + 1, dtype=bool)
        end[np.cumsum(self.length)] = True
        self.rank[at] = NONE
        at = at[~end[at + 1]]
        self.rank[at], self.made[at] = _ranks(self.sym[at], self.sym[at + 1], m)

    def best(self):
        return np.minimum.reduceat(self.rank, np.cumsum(self.length) - self.length)

    def merged(self, at, m):
        """A copy with the pairs at these places merged: the left symbol becomes the piece, the right one goes."""
        keep = np.ones(len(self.sym), dtype=bool)
        keep[at + 1] = False
        sym, rank, made = self.sym.copy(), self.rank, self.made
        sym[at] = made[at]
        gone = np.bincount(self.owner(at), minlength=len(self.length))
        out = _Ragged(sym[keep], self.length - gone, self.which, rank[keep], made[keep])
        now = at - np.arange(len(at))  # their places in the copy
        out.update(np.union1d(now, now[now > 0] - 1), m)
        return out

    def owner(self, at):
        return np.searchsorted(np.cumsum(self.length), at, side="right")

    def only(self, keep):
        """The sequences of a mask."""
        rows = np.repeat(keep, self.length)
        return _Ragged(self.sym[rows], self.length[keep], self.which[keep], self.rank[rows], self.made[rows])


def merge_ragged(words: list[str], m: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each word (not empty, with its leading mark), and whether the mark stays alone."""
    count, bare = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=bool)
    mark = int(_symbols(MARK, m)[0])
    r = _Ragged.of(_symbols("".join(words), m), np.array([len(w) for w in words]), np.arange(len(words)), m)
    while len(r.length):
        best = r.best()
        done = best == NONE
        if done.mean() > 0.2 or done.all():  # sequences without a pair leave
            out = r.only(done)
            cost = np.where(out.sym >= 0, m.cost[np.maximum(out.sym, 0)], -out.sym)
            start = np.cumsum(out.length) - out.length
            count[out.which] = np.add.reduceat(cost, start)
            bare[out.which] = out.sym[start] == mark
            r, best = r.only(~done), best[~done]
            if not len(r.length):
                break
        wide = np.repeat(best, r.length)
        at = _apart(np.flatnonzero((r.rank == wide) & (wide != NONE)))
        new = r.merged(at, m)
        early = new.best() < best  # a merge made a pair that ranks before the others
        if early.any():
            seq = r.owner(at)
            later = np.r_[False, seq[1:] == seq[:-1]]
            if (later & early[seq]).any():
                new = r.merged(at[~(later & early[seq])], m)  # there, only the leftmost merge for now
        r = new
    return count, bare


def merge_long(word: str, m: Merges) -> tuple[int, bool]:
    """The same for one long word: pairs leave a heap by rank, then from the left."""
    sym = _symbols(word, m)
    rank, made = _ranks(sym[:-1], sym[1:], m)
    sym, made = sym.tolist(), made.tolist()
    n = len(sym)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(r, i, sym[i], sym[i + 1], made[i]) for i, r in enumerate(rank.tolist()) if r != NONE]
    heapq.heapify(heap)
    table = _pair_table(m)
    alive = [True] * n

    def push(i, j):
        if i >= 0 and j >= 0 and (x := table.get(sym[i] << 32 | sym[j])) and sym[i] >= 0 and sym[j] >= 0:
            heapq.heappush(heap, (x[0], i, sym[i], sym[j], x[1]))

    while heap:
        _, i, a, b, new = heapq.heappop(heap)
        j = right[i]
        if not alive[i] or j < 0 or sym[i] != a or sym[j] != b:
            continue
        sym[i], alive[j], right[i] = new, False, right[j]
        if right[j] >= 0:
            left[right[j]] = i
        push(left[i], i)
        push(i, right[i])
    total = sum((int(m.cost[s]) if s >= 0 else -s) for s, x in zip(sym, alive, strict=True) if x)
    return total, sym[0] == int(_symbols(MARK, m)[0])


def _pair_table(m: Merges) -> dict:
    t = m.__dict__.get("_table")
    if t is None:
        t = m.__dict__["_table"] = dict(zip(m.pair_key.tolist(),
                                            zip(m.pair_rank.tolist(), m.pair_symbol.tolist(), strict=True),
                                            strict=True))
    return t


def run_tokens(n: int, m: Merges) -> int:
    """Tokens of n marks in a row: equal ranks, so the leftmost pair that makes a piece merges first.

    No pair on the stack merges.  The next mark merges into its top or comes on top; a longer merge further left, which
    would come first, is tried after each merge.  Every mark and every merge is handled once.
    """
    if n not in m.run_counts:
        stack, pieces = [1], m.runs
        for _ in range(n - 1):
            if stack[-1] + 1 not in pieces:
                stack.append(1)
                continue
            stack[-1] += 1
            while len(stack) > 1 and stack[-2] + stack[-1] in pieces:
                top = stack.pop()
                stack[-1] += top
        m.run_counts[n] = len(stack)
    return m.run_counts[n]


def _learn(words: set[str], m: Merges) -> None:
    """Remember tokens * 2 + (the mark stays alone) of new words; a lone mark isn't counted here."""
    if len(m.words) + len(words) > CACHE_WORDS:
        m.words.clear()
    short = [w for w in words if len(w) < LONG]
    for at in range(0, len(short), 20_000):
        part = short[at:at + 20_000]
        count, bare = merge_ragged([MARK + w for w in part], m)
        m.words.update(zip(part, (2 * (count - bare) + bare).tolist(), strict=True))
    for w in words:
        if len(w) >= LONG:
            count, bare = merge_long(MARK + w, m)
            m.words[w] = 2 * (count - bare) + bare


def _parts(text: str) -> list[str]:
    """A long text in parts, cut at single spaces: the mark that a part begins with stands for the space."""
    out, at = [], 0
    while len(text) - at > LONG_TEXT and (cut := _SINGLE_SPACE.search(text, at + LONG_TEXT)):
        out.append(text[at:cut.start() + 1])
        at = cut.start() + 2
    return [*out, text[at:]]


def count_text_list(texts, m: Merges) -> list[int]:
    """Tokens of each whole text; null and empty texts have none."""
    if any(t and len(t) > LONG_TEXT for t in texts):
        return [sum(sum(_count_texts([p], m)) for p in _parts(t.replace(MARK, " "))) if t and len(t) > LONG_TEXT
                else _count_texts([t], m)[0] for t in texts]
    return _count_texts(texts, m)


def _count_texts(texts, m: Merges) -> list[int]:
    out = []
    words = [t.replace(MARK, " ").split(" ") if t else [] for t in texts]
    known = m.words
    new = {w for ws in words for w in ws if w and w not in known}
    if new:
        _learn(new, m)
        if any(w and w not in known for ws in words for w in ws):  # the memory was emptied
            _learn({w for ws in words for w in ws if w}, m)
    for ws in words:
        if "" not in ws:
            codes = [known[w] for w in ws]
            out.append((sum(codes) + sum(c & 1 for c in codes)) >> 1)  # a lone mark is a token
            continue
        total = run = 0
        for w in ws:
            if not w:
                run += 1
                continue
            c = known[w]
            if c & 1:
                total += run_tokens(run + 1, m)
            elif run:
                total += run_tokens(run, m)
            run = 0
            total += c >> 1
        out.append(total + (run_tokens(run, m) if run else 0))
    return out


@lru_cache(maxsize=4)
def _loaded(path: str) -> Merges:
    return load(path)


def token_count(text: Column, model_path: str) -> Column:
    """Tokens of whole texts (long); null and empty texts: 0."""
    spark = SparkSession.active()
    ship_package(spark)
    shared = spark.sparkContext.broadcast(_loaded(model_path))  # as large as the model file allows

    @F.pandas_udf("long")
    def tokens(s: pd.Series) -> pd.Series:
        m, texts, out = shared.value, s.tolist(), []
        at = 0
        while at < len(texts):  # some MB of text at a time
            size, to = 0, at
            while to < len(texts) and size < LONG_TEXT:
                size += len(texts[to] or "")
                to += 1
            out += count_text_list(texts[at:to], m)
            at = to
        return pd.Series(out, dtype="int64")
    return tokens(text)


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` of every row; null texts count as empty."""
    out = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                      token_count(F.col("text"), model_path).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
