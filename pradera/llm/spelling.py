"""Spelling variants: words that differ by exactly one inserted, deleted or replaced code point.

Two words within one edit agree up to the position of the edit, the length of their common prefix, and behind it.  So a
pair is looked for in a block: words of one length class (the shorter word's length) that share what lies before and
behind a range of WIDTH or more positions.  Every pair has one class and one edit position, hence exactly one block, and
a word is in at most 2 RANGES of them.  A block of more than BLOCK_ROWS words is cut into smaller ranges, down to one
position; what shares all but one position is bounded by the alphabet, not by the vocabulary.

In a block the words are sorted and every word scans those behind it by dynamic programming.  A row of the edit matrix
has a band of three cells, as only one edit is of interest; the rows for the prefix that a word shares with the one
scanned before are reused (adjacent LCPs); and if a prefix's row exceeds one edit everywhere, the scan goes on behind
all words with that prefix.  All words of a batch scan in step, as arrays.  Blocks return a count and the best near word
for each word, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .groups import over_groups

LENGTH, COUNT = 7, 2   # code points and occurrences that a word has at least
RATIO = 10             # a form is so many times as frequent as its variant
DROPPED = 31           # one in so many runs loses a code point (``misspelt``)
WIDTH = 3              # positions of a block's range, at least
RANGES = 8             # of a word, at most
BLOCK_ROWS = 4096
CELLS = 1 << 22        # code points of the words that scan in step
RUN = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_FOUND = "word string, n_near long, best_n long, best string"


def runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id`` and ``run``: every maximal run of letters of at least ``length`` code points, A-Z in lower case.

    Null texts and texts without such a run give no row; texts are read whole; repeated rows count as often as they
    occur; other columns aren't read."""
    found = F.explode(F.regexp_extract_all("text", F.lit(f"{RUN}{{{length},}}"), F.lit(0)))
    return docs.select("doc_id", found.alias("run")).withColumn("run", F.translate("run", UPPER, LOWER))


def misspelt(found: DataFrame, dropped: int = DROPPED) -> Column:
    """The word that a run stands for: where the CRC-32 h of ``<doc_id>:<run>`` is a multiple of ``dropped``, without
    its code point h mod length.  A null doc_id counts as empty text."""
    mark = F.crc32(F.concat(F.coalesce(found["doc_id"].cast("string"), F.lit("")), F.lit(":"), found["run"]))
    at = (mark % F.length(found["run"])).cast("int")
    less = F.concat(found["run"].substr(F.lit(1), at), found["run"].substr(at + 2, F.length(found["run"])))
    return F.when(mark % dropped == 0, less).otherwise(found["run"])


def vocabulary(words: DataFrame, length: int = LENGTH, count: int = COUNT) -> DataFrame:
    """``word``, ``n`` of the words with enough code points and occurrences."""
    words = words.where(F.length("word") >= length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)


def _blocks(rows: DataFrame, width: Column) -> DataFrame:
    """Cuts the range lo .. hi - 1 of each row (``word``, ``n``, ``lam``, ``lo``, ``hi``) into ranges of ``width``
    positions, and adds their block: ``region`` (class and range) and ``gkey`` (of the ends that its words share)."""
    rows = rows.select("word", "n", "lam", "hi", width.alias("_w"), F.explode(F.sequence(
        F.col("lo"), F.col("hi") - 1, width)).alias("lo"))
    rows = rows.withColumn("hi", F.least(F.col("lo") + F.col("_w"), "hi")).drop("_w")
    tail = F.greatest(F.col("lam") - F.col("hi"), F.lit(0))
    head = F.col("word").substr(F.lit(1), F.col("lo"))
    end = F.col("word").substr(F.length("word") - tail + 1, tail)
    return rows.withColumns({"region": F.col("lam").cast("long") * (1 << 30) + F.col("lo"),
                             "gkey": F.xxhash64("hi", head, F.lit(":"), end)})


def _width(size: Column, least: int) -> Column:
    """Positions of a range when ``size`` of them are cut: at most RANGES ranges, however long words are."""
    return F.greatest(F.lit(least), F.ceil(size / RANGES).cast("int"))


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, a row per word with a 0 before and two behind, and lengths."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    out = np.zeros((len(words), int(size.max(initial=0)) + 3), dtype=np.uint32)
    inside = np.arange(out.shape[1])[None, :]
    out[(inside >= 1) & (inside <= size[:, None])] = codes
    return out, size


def near_pairs(words: list[str], starts: np.ndarray, lam: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Index pairs (i < j) of words within one edit, of the block's class and with the edit in lo .. hi - 1.

    ``words``: sorted and distinct within each block; ``starts``: where blocks begin.
    """
    n = len(words)
    code, size = _matrix(words)
    wide = code.shape[1] - 3
    differ = code[1:, 1:] != code[:-1, 1:]
    lcp = np.full(n + 1, -1, dtype=np.int64)
    lcp[1:n] = np.argmax(differ, axis=1)
    lcp[starts] = -1
    # behind[d, i]: the next word that doesn't share d code points with word i
    behind = np.empty((wide + 2, n), dtype=np.int64)
    for d in range(wide + 2):
        at = np.flatnonzero(lcp < d) if d else np.flatnonzero(lcp < 0)
        behind[d] = at[np.searchsorted(at, np.arange(n), side="right")]
    end = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))

    # rows[q, d]: cells d-1, d, d+1 of the edit matrix between word q and the first d code points of the word scanned
    rows = np.empty((n, wide + 1, 3), dtype=np.int8)
    rows[:] = (1, 0, 1)
    q = np.arange(n)
    at = behind[np.minimum(hi, wide + 1), q]  # words that share more have their edit behind the range
    shared = np.full(n, wide, dtype=np.int64)
    some = at < end
    q, at, shared = q[some], at[some], shared[some]
    first, second = [], []
    while len(q):
        depth = lcp[at].copy()
        shared = np.minimum(shared, depth)
        dead = np.zeros(len(q), dtype=np.int64)  # depth at which no cell is left
        go = np.arange(len(q))
        while len(go):
            go = go[depth[go] < size[at[go]]]
            a, d = q[go], depth[go]
            c = code[at[go], d + 1]
            above = rows[a, d]
            c0 = np.minimum(above[:, 0] + (code[a, d] != c), above[:, 1] + 1)
            c1 = np.minimum(np.minimum(above[:, 1] + (code[a, d + 1] != c), above[:, 2] + 1), c0 + 1)
            c2 = np.minimum(above[:, 2] + (code[a, d + 2] != c), c1 + 1)
            rows[a, d + 1, 0], rows[a, d + 1, 1], rows[a, d + 1, 2] = c0, c1, c2
            depth[go] = d + 1
            over = np.minimum(np.minimum(c0, c1), c2) > 1
            dead[go[over]] = d[over] + 1
            go = go[~over]
        cell = size[q] - size[at] + 1
        whole = (dead == 0) & (cell >= 0) & (cell <= 2)
        hit = np.flatnonzero(whole)
        hit = hit[rows[q[hit], size[at[hit]], cell[hit]] == 1]
        hit = hit[(np.minimum(size[q[hit]], size[at[hit]]) == lam[q[hit]]) & (shared[hit] >= lo[q[hit]])
                  & (shared[hit] < hi[q[hit]])]
        first.append(q[hit])
        second.append(at[hit])
        at = np.where(dead > 0, behind[dead, at], at + 1)
        some = at < end[q]
        q, at, shared = q[some], at[some], shared[some]
    return (np.concatenate(first), np.concatenate(second)) if first else (np.zeros(0, int), np.zeros(0, int))


def _chunks(lam: np.ndarray, size: np.ndarray):
    """Runs of blocks (by length class and number of words) whose words fit into one matrix."""
    at = 0
    for k in range(1, len(lam) + 1):
        if k == len(lam) or lam[k] > 2 * lam[at] or size[at:k + 1].sum() * lam[k] > CELLS:
            yield at, k
            at = k


def _scan(table: pa.Table, starts: np.ndarray):
    """Words with near words in a batch of blocks: how many, and the most frequent (ties: the smallest)."""
    size = np.diff(np.r_[starts, table.num_rows])
    several = np.repeat(size > 1, size)
    if not several.any():
        return
    table = table.filter(pa.array(several)).combine_chunks()
    size = size[size > 1]
    starts = np.r_[0, np.cumsum(size)[:-1]]
    for a, b in _chunks(table.column("lam").to_numpy()[starts], size):
        yield from _scan_chunk(table.slice(starts[a], size[a:b].sum()), starts[a:b] - starts[a])


def _scan_chunk(table: pa.Table, starts: np.ndarray):
    n = table.column("n").to_numpy()
    i, j = near_pairs(table.column("word").to_pylist(), starts,
                      *(table.column(c).to_numpy().astype(np.int64) for c in ("lam", "lo", "hi")))
    if not len(i):
        return
    word, near = np.r_[i, j], np.r_[j, i]
    order = np.lexsort((near, -n[near], word))
    word, near = word[order], near[order]
    at = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    text = table.column("word").combine_chunks()
    yield pa.record_batch([text.take(pa.array(word[at])), pa.array(np.diff(np.r_[at, len(word)])),
                           pa.array(n[near[at]]), text.take(pa.array(near[at]))],
                          names=["word", "n_near", "best_n", "best"])


def near_words(vocab: DataFrame, length: int = LENGTH, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``word``, ``n_near``, ``best_n``, ``best`` of words that have a near word; ``vocab`` has distinct ``word``, ``n``.

    Words shorter than ``length`` are in no class; null words aren't words."""
    size = F.length("word")
    # a word's own class, and the one of words that it is one longer than
    classes = F.filter(F.array(size, size - 1), lambda x: x >= length)
    rows = vocab.where("word is not null").select("word", "n", F.explode(classes).alias("lam"))
    rows = rows.select("word", "n", "lam", F.lit(0).alias("lo"), (F.col("lam") + 1).alias("hi"))
    rows, ready = _blocks(rows, _width(F.col("lam") + 1, WIDTH)), []
    while True:
        big = rows.groupBy("region", "gkey").agg(F.count(F.lit(1)).alias("_rows"), F.max(F.col("hi") - F.col("lo")).alias("_w"))
        big = stored(big.where((F.col("_rows") > block_rows) & (F.col("_w") > 1)).select("region", "gkey"), "spelling-big")
        if big.isEmpty():
            break
        ready.append(rows.join(big, ["region", "gkey"], "left_anti"))
        rows = _blocks(rows.join(big, ["region", "gkey"], "left_semi"), _width(F.col("hi") - F.col("lo"), 1))
    for r in ready:
        rows = rows.unionByName(r)
    found = over_groups(rows, ["region", "gkey"], "word", _scan, _FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("best")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best")))


def variants(vocab: DataFrame, length: int = LENGTH, ratio: int = RATIO, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per word of ``vocab`` (distinct ``word``, ``n``): ``word``, ``form``, ``root``, ``n``, ``n_near``,
    ``form_n``.

    A word's form is its near word of largest n (ties: the smallest), if that is ``ratio`` times its own or more.  The
    root is the last word when forms are followed; n grows by ``ratio`` each time, so there are few steps, and they
    are followed by pointer doubling.  An empty vocabulary gives no row."""
    vocab = stored(vocab, "spelling-vocabulary")
    near = near_words(vocab, length, block_rows)
    form = F.col("best_n") >= F.col("n") * ratio
    out = stored(vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(form, F.col("best")).alias("form"), F.when(form, F.col("best_n")).alias("form_n")), "spelling-forms")
    up = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        up = stored(up, "spelling-roots")
        on = up.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if up.join(on, "root", "left_semi").isEmpty():
            break
        up = up.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
    return out.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                               "form_n")


def sql(documents: str = "documents") -> str:
    """DuckDB SQL for the rows of the query: near words by deleting each position, and no blocks."""
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(m)),
        lambda i: ('0x' || substr(hex(encode(m)), 2 * i + 1, 2))::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)),
          lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""
    return rf"""
WITH RECURSIVE runs AS (
  SELECT translate(run, '{UPPER}', '{LOWER}') AS run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM {documents})
  WHERE length(run) >= {LENGTH}),
marked AS (SELECT run, k, {crc} AS h FROM (SELECT run, id || run AS m, count(*) AS k FROM runs GROUP BY ALL)),
words AS (
  SELECT CASE WHEN h % {DROPPED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
         ELSE run END AS word, k FROM marked),
vocab AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM words WHERE length(word) >= {LENGTH}
          GROUP BY word HAVING sum(k) >= {COUNT}),
cut AS (SELECT word, n, length(word) AS size, unnest(range(1, length(word) + 1)) AS i FROM vocab),
less AS (SELECT *, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM cut),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS m FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN vocab b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN vocab b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY m DESC, near) AS near, max(m) AS m FROM pairs GROUP BY word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {RATIO} * v.n THEN near END AS form,
         CASE WHEN m >= {RATIO} * v.n THEN m END AS form_n FROM vocab v LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, form FROM forms
  UNION ALL SELECT c.word, c.form, f.form FROM chain c JOIN forms f ON f.word = c.form)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.form IS NULL
"""
