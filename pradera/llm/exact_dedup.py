"""Exact duplicates of whole texts, through an extendible-hash index on files in the cluster's shared folder.

Texts are equal when they are identical after every white-space character of ASCII is deleted.  A text's key is the
first ``key_bits`` bits of the SHA-256 of what is left.

1. *Pages.*  Every task groups its rows into pages of up to PAGE_BYTES of distinct texts, comparing bytes; equal rows of
   a page share a slot.  The pages are written once: a narrow record for every row, the text once for every slot.  So a
   group with a third of all rows reaches the next steps as one record a page.
2. *Directory.*  Slots' bytes are summed up by key prefix.  All prefixes of the first depth are buckets; as long as a
   bucket holds more than BUCKET_BYTES the directory doubles and the overfull buckets split by one more bit.  A bucket
   that the last depth can't split is chained.  The directory is a table of the shared folder and isn't collected.
3. *Owners.*  Each range of keys (the first depth's prefixes) has one owner task, which gets its part of the directory
   and its slots in the order of keys.  It takes one bucket after the other, chains the slots whose keys collide, and
   puts a slot into a chain's group only if their bytes are the same.
4. Slots carry the groups' answers back to the rows, on (page, slot), which no group can make hot.

A key whose slots hold more than CHAIN_BYTES is combined first: they are dealt to salted tasks, equal ones become one
slot, and that is repeated while such keys get smaller.

Null texts count as empty, and texts that are empty or only white space are one group.  Null doc_ids come after all
others in a tie.  Repeated rows are rows of their own: exactly one row of a group is kept.  An empty table gives no row.
Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pradera.session import ship_package

from .common import stored

PAGE_BYTES = 32 << 20    # distinct texts that a task holds
PAGE_ROWS = 1 << 17
BUCKET_BYTES = 4 << 20   # of slots
OWNER_BYTES = 16 << 20   # of slots in an owner's range of keys, on average
CHAIN_BYTES = 256 << 20  # of one key's slots that a task reads one after the other
BITS = 63                # of keys, so that they sort as numbers
SPARE = 4                # bits by which the last depth exceeds what even buckets would need
SLICE = 512              # rows taken from a batch at a time
OUT_BYTES = 4 << 20      # of a batch that leaves a task
BLANKS = b" \t\n\x0b\x0c\r"
NO_ID = 1 << 63          # in place of null when ids are compared

_SLOT = "n long, chars long, best_id long, best_row long, bytes long, body binary"
PAGES = f"page long, slot long, row long, doc_id long, key long, sha binary, {_SLOT}"
ANSWERS = "page long, slot long, keep_id long, keep_page long, keep_row long, group_size long, sha binary"
COMBINED = f"page long, slot long, up_page long, up_slot long, key long, sha binary, best_page long, {_SLOT}"


def _type(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(","))])


def _batches(rows: list[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about OUT_BYTES; ``size``: which column holds a row's bytes."""
    at = 0
    while at < len(rows):
        to = held = 0
        while at + to < len(rows) and held < OUT_BYTES:
            held += 64 + (len(rows[at + to][size] or b"") if size >= 0 else 0)
            to += 1
        part = rows[at:at + to]
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)],
                              schema=schema)
        at += to


def _rank(chars: int, doc_id: int | None, page: int, row: int) -> tuple:
    """What the row that stays has the smallest of."""
    return -chars, NO_ID if doc_id is None else doc_id, page, row


def pages(docs: DataFrame, page_bytes: int = PAGE_BYTES, key_bits: int = BITS) -> DataFrame:
    """A record for every row of ``docs``; the first row of a slot also has the slot's fields and its text."""
    schema = _type(PAGES)

    def run(batches):
        page = TaskContext.get().partitionId() << 32
        slots: dict[bytes, list] = {}  # normalised text -> slot, rows, best rank, best row, sha, key
        rows: list[tuple] = []
        held = 0

        def close():
            out, seen = [], set()
            by_slot = {s[0]: (body, s) for body, s in slots.items()}
            for row, (slot, doc_id) in enumerate(rows):
                body, s = by_slot[slot]
                about = [None] * 6
                if slot not in seen:
                    seen.add(slot)
                    chars, best_id, _, best_row = s[2]
                    about = [s[1], -chars, None if best_id == NO_ID else best_id, best_row, len(body) + 64, body]
                out.append((page, slot, row, doc_id, s[4], s[3], *about))
            return _batches(out, schema, len(schema) - 1)

        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                part = whole.slice(at, SLICE)
                for doc_id, text, chars in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "chars")),
                                               strict=True):
                    body = text.translate(None, BLANKS)
                    slot = slots.get(body)
                    rank = _rank(chars, doc_id, 0, len(rows))
                    if slot is None:
                        sha = hashlib.sha256(body).digest()
                        key = int.from_bytes(sha[:8], "big") >> 1 >> (BITS - key_bits) << (BITS - key_bits)
                        slot = slots[body] = [len(slots), 0, rank, sha, key]
                        held += len(body) + 64
                    slot[1] += 1
                    slot[2] = min(slot[2], rank)
                    rows.append((slot[0], doc_id))
                    if held >= page_bytes or len(rows) >= PAGE_ROWS:
                        yield from close()
                        page, slots, rows, held = page + 1, {}, [], 0
        if rows:
            yield from close()

    ship_package(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"),
                       F.length(text).cast("long").alias("chars")).mapInArrow(run, PAGES)


def _prefix(key: Column, depth: int, bits: int = BITS) -> Column:
    return F.shiftrightunsigned(key, bits - depth) if depth else F.lit(0).cast("long")


def directory(slots: DataFrame, first: int, last: int, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The buckets: ``key`` (the first of its range), ``depth``, ``bytes``; from ``slots`` with ``key`` and ``bytes``.

    Each round doubles the directory: buckets that are overfull at one depth are split by the next bit.  Only whether
    any is left comes to the driver.
    """
    cells = stored(slots.groupBy(_prefix(F.col("key"), last).alias("cell")).agg(F.sum("bytes").alias("bytes")),
                   "hash-cells")
    done = []
    for depth in range(first, last + 1):
        cells = cells.withColumn("prefix", _prefix(F.col("cell"), depth, last))
        buckets = stored(cells.groupBy("prefix").agg(F.sum("bytes").alias("bytes")), "hash-directory")
        full = (F.col("bytes") > bucket_bytes) & F.lit(depth < last)
        done.append(buckets.where(~full).select(F.shiftleft("prefix", BITS - depth).alias("key"),
                                                F.lit(depth).alias("depth"), "bytes"))
        if buckets.where(full).isEmpty():
            break
        cells = stored(cells.join(buckets.where(full).select("prefix"), "prefix", "left_semi"), "hash-cells")
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


class _Chains:
    """The chains of one bucket: for every key its groups of equal bytes."""

    def __init__(self):
        self.chains: dict[int, list[list]] = {}

    def add(self, key, body, sha, page, slot, n, rank):
        chain = self.chains.setdefault(key, [])
        for group in chain:
            if group[0] == body:  # bytes are compared
                break
        else:
            group = [body, sha, 0, rank, []]
            chain.append(group)
        group[2] += n
        group[3] = min(group[3], rank)
        group[4].append((page, slot))

    def groups(self):
        for key, chain in self.chains.items():
            for group in chain:
                yield key, group


_READ = ("key", "body", "sha", "page", "slot", "n", "chars", "best_id", "best_page", "best_row")


def _slots_of(part: pa.RecordBatch):
    for key, body, sha, page, slot, n, chars, best_id, best_page, best_row in zip(
            *(part.column(c).to_pylist() for c in _READ), strict=True):
        yield key, body, sha, page, slot, n, _rank(chars or 0, best_id, best_page, best_row)


def owners(slots: DataFrame, buckets: DataFrame, first: int) -> DataFrame:
    """Every slot's answer: the row that stays, its group's rows, its text's digest."""
    schema = _type(ANSWERS)

    def answers(chains):
        out = []
        for _, (_, sha, size, (_, best_id, best_page, best_row), members) in chains.groups():
            keep = (None if best_id == NO_ID else best_id, best_page, best_row, size, sha)
            out += [(*m, *keep) for m in members]
        return _batches(out, schema, -1)

    def run(batches):
        chains = _Chains()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                for x in _slots_of(whole.slice(at, SLICE)):
                    if x[1] is None:  # an entry of the directory: the next bucket begins
                        yield from answers(chains)
                        chains = _Chains()
                    else:
                        chains.add(*x)
        yield from answers(chains)

    entries = buckets.select("key", *[F.lit(None).cast(slots.schema[c].dataType).alias(c) for c in _READ[1:]])
    rows = slots.select(*_READ).union(entries).withColumn("owner", _prefix(F.col("key"), first))
    ship_package(slots.sparkSession)
    return (rows.repartition("owner").sortWithinPartitions("key", F.col("body").isNotNull(), "page", "slot")
            .drop("owner").mapInArrow(run, ANSWERS))


def _combine(slots: DataFrame) -> DataFrame:
    """Equal slots of one (key, salt) as one, the first; ``up_page``, ``up_slot``: which one a slot became part of."""
    schema = _type(COMBINED)

    def close(chains):
        out = []
        for key, (body, sha, n, (chars, best_id, best_page, best_row), members) in chains.groups():
            first = members[0]
            about = (n, -chars, None if best_id == NO_ID else best_id, best_row, len(body) + 64, body)
            out += [(*m, *first, key, sha, best_page, *(about if m == first else (None,) * 6)) for m in members]
        return _batches(out, schema, len(schema) - 1)

    def run(batches):
        chains, now = _Chains(), None
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                part = whole.slice(at, SLICE)
                for salt, x in zip(part.column("salt").to_pylist(), _slots_of(part), strict=True):
                    if now != (x[0], salt):
                        yield from close(chains)
                        chains, now = _Chains(), (x[0], salt)
                    chains.add(*x)
        yield from close(chains)
    ship_package(slots.sparkSession)
    return (slots.select(*_READ, "salt").repartition("key", "salt")
            .sortWithinPartitions("key", "salt", "page", "slot").mapInArrow(run, COMBINED))


def duplicates(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, owner_bytes: int = OWNER_BYTES,
               page_bytes: int = PAGE_BYTES, chain_bytes: int = CHAIN_BYTES, key_bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id`` (of the row that stays: most code points, then smallest
    doc_id), ``group_size``, ``kept``, ``text_sha256``.  See the module for what nulls and ties do."""
    index = stored(pages(docs, page_bytes, key_bits), "hash-pages")
    slots = index.where("n is not null").withColumn("best_page", F.col("page"))

    ups = []  # of each round: which slot a combined one became part of
    while True:
        load = slots.groupBy("key").agg(F.sum("bytes").alias("_bytes"), F.max("bytes").alias("_one"),
                                        F.count(F.lit(1)).alias("_slots"))
        # a task must get some slots to combine, however long they are
        load = load.where(F.col("_bytes") > chain_bytes).withColumn(
            "_salts", F.ceil(F.least(F.col("_bytes") / chain_bytes, F.col("_slots") / 8)).cast("long"))
        hot = stored(load.where("_slots > 1").select("key", "_slots", "_salts"), "hash-hot")
        before = hot.agg(F.sum("_slots")).first()[0]
        if not before:
            break
        salt = F.pmod(F.xxhash64("page", "slot"), F.col("_salts"))
        combined = stored(_combine(slots.join(hot, "key").withColumn("salt", salt)), "hash-combined")
        ups.append(combined.select("page", "slot", "up_page", "up_slot"))
        left = combined.where("n is not null").drop("up_page", "up_slot")
        slots = slots.join(hot.select("key"), "key", "left_anti").select(*left.columns).union(left)
        if left.count() == before:  # different texts of one key: an owner chains them
            break

    total = slots.agg(F.sum("bytes")).first()[0] or 0
    first = min(key_bits, math.ceil(math.log2(max(1, total / owner_bytes))))
    last = min(key_bits, max(first, math.ceil(math.log2(max(1, total / bucket_bytes))) + SPARE))
    found = owners(slots, directory(slots.select("key", "bytes"), first, last, bucket_bytes), first)
    if ups:
        found = stored(found, "hash-answers")
        for up in reversed(ups):
            parts = up.where("page <> up_page OR slot <> up_slot")
            rest = found.drop("page", "slot").columns
            found = found.union(parts.join(found.select(F.col("page").alias("up_page"), F.col("slot").alias("up_slot"),
                                                        *rest), ["up_page", "up_slot"]).select("page", "slot", *rest))
    rows = index.select("page", "slot", "row", "doc_id")
    kept = (F.col("page") == F.col("keep_page")) & (F.col("row") == F.col("keep_row"))
    return rows.join(found, ["page", "slot"]).select("doc_id", "keep_id", "group_size", kept.alias("kept"),
                                                     F.lower(F.hex("sha")).alias("text_sha256"))


def sql(documents: str = "documents") -> str:
    """DuckDB SQL for the rows of ``duplicates``."""
    return rf"""
WITH norm AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM {documents}),
ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM norm WINDOW w AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM ranked
"""
