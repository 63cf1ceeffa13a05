"""Mixing sources to target weights, with DataFrame functions only.

A source's documents are laid end to end (by a hash bucket of the id, then the id) and their words are cut into blocks
of BLOCK words.  A source's target decides how many slots of the mix its blocks fill; slot k is round k div n of its n
blocks, and a pseudorandom permutation of each round maps k mod n to a block index.  All slots together are dealt to
output shards by one more permutation, so a shard's source counts are multinomial draws given the totals: targets are
met exactly, and no block is used more than ``repeats`` times.  Slots and blocks meet in a join on the block index, on narrow
rows: what a document gives to a block is a number of words there.  The mix then takes its texts to the slots that were
found for them, and to their shards, where they lie in order of place: texts are shuffled twice, and counts need none.

The permutations are swap-or-not networks: each round exchanges x with (key - x) mod n if a bit drawn from the pair
says so.  That is a bijection for any n, needs no table, and runs backwards with the rounds reversed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

BLOCK = 64                 # words
REPEATS = 3                # a source's target stops at so many times its size
SHARD_BLOCKS = 4096        # slots of an output shard
BUCKET_ROWS = 2_000        # rows of a bucket; a source's buckets are laid end to end
SLOT_CHUNK = 1 << 14       # slots made by one row before they are spread
ROUNDS = 24
PRIME = (1 << 31) - 1
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _number(label: Column, digits: int = 12) -> Column:
    """Non-negative number from a text's MD5 (the first ``digits`` hexadecimal digits)."""
    return F.conv(F.substring(F.md5(label), 1, digits), 16, 10).cast("long")


def round_keys(label: Column, n: Column) -> Column:
    """Keys of a permutation of 0 .. n - 1: for each round the centre of the exchange and a multiplier."""
    tag = lambda kind, r: F.concat_ws(":", F.lit(kind), label, r.cast("string"))
    return F.transform(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), lambda r: F.struct(
        (_number(tag("k", r)) % F.greatest(n, F.lit(1))).alias("k"),
        (1 + _number(tag("a", r)) % (PRIME - 1)).alias("a")))


def permute(x: Column, n: Column, keys: Column) -> Column:
    """Index that x goes to; with the keys reversed, the index that goes to x."""
    def step(at: Column, key: Column) -> Column:
        other = (key["k"] + n - at) % n
        drawn = (F.greatest(at, other) % PRIME * key["a"]) % PRIME * 2 >= PRIME
        return F.when(drawn, other).otherwise(at)
    return F.aggregate(keys, x, step)


def _int_div(a: Column, b: Column | int) -> Column:
    """Whole quotient of numbers that aren't negative."""
    return ((a - a % b) / b).cast("long")


def bucketed(docs: DataFrame, rows: int) -> DataFrame:
    """Adds ``size`` (words), ``_order`` (text's MD5, for rows that share an id) and ``_bucket``."""
    buckets = max(1, -(-rows // BUCKET_ROWS))
    return docs.withColumns({
        "size": word_count(F.col("text")),
        "_order": F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")),
        "_bucket": _number(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 8) % buckets})


def targets(sizes: DataFrame, seed: int = 0, block: int = BLOCK, repeats: int = REPEATS) -> DataFrame:
    """One row per source, from the (source, bucket) totals: number, size, weight, target, blocks, slots, round keys.

    Weights are 1, 2, 3, repeating, over the sources by code point, null last.  The targets share all words by
    weight; a target above ``repeats`` times its source's size stops there, and what is over is shared again.  With
    the sources by size per weight, those that stop come first: source k stops if its limit is below its share of
    what the ones before it leave.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))).cast("long"))
    s = s.withColumn("weight", ((F.col("sid") - 1) % 3 + 1).cast("double"))
    s = s.withColumn("_ratio", F.col("source_size") / F.col("weight"))
    by = Window.orderBy("_ratio", "sid")
    before, everything = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    limit = repeats * F.col("source_size")
    s = s.withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
    s = s.withColumn("_weights", F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("_level", F.col("_left") / F.col("_weights"))  # words per weight if all before stop
    s = s.withColumn("_stops", limit < F.col("_level") * F.col("weight"))
    level = F.min(F.when(~F.col("_stops"), F.struct("_ratio", "sid", "_level"))).over(everything)["_level"]
    s = s.withColumn("target", F.when(F.col("_stops"), limit.cast("double"))
                     .otherwise(F.least(level * F.col("weight"), limit.cast("double"))))
    s = s.withColumn("blocks", _int_div(F.col("source_size") + (block - 1), block))
    s = s.withColumn("slots", F.when(F.col("source_size") > 0, F.least(
        F.floor(F.col("target") / F.col("source_size") * F.col("blocks") + 0.5).cast("long"),
        repeats * F.col("blocks"))).otherwise(F.lit(0).cast("long")))
    s = s.withColumn("first_slot", F.coalesce(F.sum("slots").over(
        Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("all_slots", F.sum("slots").over(everything))
    keys = F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda e: round_keys(
        F.concat_ws(":", F.lit(str(seed)), F.col("sid").cast("string"), e.cast("string")), F.col("blocks")))
    return s.withColumn("keys", keys).select("source", "sid", "source_size", "weight", "target", "blocks", "slots",
                                             "first_slot", "all_slots", "keys")


def positions(rows: DataFrame, sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``sid`` and ``start`` of each row: its source's number, and the words of the source that lie before the row.

    A hot source is spread over its buckets; the buckets' totals are summed up apart and join on the same key.  The
    planner broadcasts the small tables (they are read from files of known size) or shuffles them.
    """
    number = sources.select(F.col("source").alias("_s"), "sid")
    base = sizes.join(number, sizes["source"].eqNullSafe(number["_s"])).select(
        "sid", "_bucket", F.coalesce(F.sum("size").over(Window.partitionBy("sid").orderBy("_bucket").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    before = (Window.partitionBy("sid", "_bucket").orderBy(F.asc_nulls_first("doc_id"), "_order", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.join(number, rows["source"].eqNullSafe(number["_s"])).drop("_s")
    rows = rows.withColumn("_before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return (rows.join(base, ["sid", "_bucket"]).withColumn("start", F.col("_base") + F.col("_before"))
            .drop("_base", "_before"))


def slots(sources: DataFrame, partitions: int, seed: int = 0, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """Every slot of the mix: ``sid``, ``block`` (index in the source), ``shard``, ``place`` (in the shard)."""
    deal = round_keys(F.concat_ws(":", F.lit(str(seed)), F.lit("mix")), F.col("all_slots"))
    s = sources.where("slots > 0").select("sid", "blocks", "slots", "first_slot", "all_slots", "keys",
                                          deal.alias("deal"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), _int_div(F.col("slots") - 1, SLOT_CHUNK))).alias("_chunk")
    s = s.select("*", chunk).repartition(partitions, "sid", "_chunk")  # joined back, the keys could be the one task
    first = F.col("_chunk") * SLOT_CHUNK
    s = s.withColumn("slot", F.explode(F.sequence(first, F.least(first + SLOT_CHUNK, F.col("slots")) - 1)))
    keys = F.element_at("keys", (_int_div(F.col("slot"), F.col("blocks")) + 1).cast("int"))
    place = permute(F.col("first_slot") + F.col("slot"), F.col("all_slots"), F.col("deal"))
    return s.select("sid", permute(F.col("slot") % F.col("blocks"), F.col("blocks"), keys).alias("block"),
                    place.alias("_place")).select(
        "sid", "block", _int_div(F.col("_place"), shard_blocks).alias("shard"),
        (F.col("_place") % shard_blocks).alias("place"))


def _key(docs: DataFrame) -> Column:
    """Key of a row, from its id, source and text: rows that share it can stand for one another."""
    text = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return F.unhex(F.md5(F.to_json(F.struct(F.col("doc_id"), F.col("source"), text.alias("t"))).cast("binary")))


def _plan(docs: DataFrame, seed: int, block: int, repeats: int):
    """Narrow rows (written once), (source, bucket) totals and the source table."""
    rows = docs.count()
    narrow = bucketed(docs.select("doc_id", "text", "source").withColumn("_key", _key(docs)), rows).drop("text")
    narrow = stored(narrow, "mix-rows")
    sizes = stored(narrow.groupBy("source", "_bucket").agg(F.sum("size").alias("size")), "mix-sizes")
    return rows, narrow, sizes, stored(targets(sizes, seed, block, repeats), "mix-sources")


def drawn(placed: DataFrame, sources: DataFrame, seed: int = 0, block: int = BLOCK,
          shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """The join of slots and blocks, without texts: a row for each slot and each document that gives words to its block.

    ``placed`` (``sid``, ``start``, ``size`` and more): with ``block``, ``words`` (that it gives) and the slot's ``shard`` and
    ``place``, which are null for a block that no slot holds."""
    partitions = max(1, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chosen = stored(slots(sources, partitions, seed, shard_blocks), "mix-slots")  # so that their size is known
    first, last = _int_div(F.col("start"), block), _int_div(F.col("start") + F.col("size") - 1, block)
    parts = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    at = F.col("block") * block
    parts = parts.withColumn("words", F.least(F.col("start") + F.col("size"), at + block) - F.greatest(F.col("start"), at))
    return parts.join(chosen, ["sid", "block"], "left")


def mix(docs: DataFrame, seed: int = 0, block: int = BLOCK, repeats: int = REPEATS,
        shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """The mix itself: one row per slot and piece, a piece being what one document gives to the slot's block.

    ``shard`` and ``place`` (the slot), ``sid`` and ``block`` (what is in it), ``start`` (of the document in its
    source, in words), ``text`` (the document's contiguous words in the block, with the white space in front of them,
    and behind the document's last word), ``ends`` (whether the document ends with it) and ``doc`` (the document's other
    columns).  Shards come whole and in order of place and start.  Texts without words are in no block.
    """
    _, narrow, sizes, sources = _plan(docs, seed, block, repeats)
    found = drawn(positions(narrow, sizes, sources).select("sid", "_key", "start", "size"), sources, seed, block, shard_blocks)
    found = found.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("start", "block", "shard", "place", "sid")))
                                      .alias("_draws"))
    # rows that share a key take its starts one after the other
    rows = docs.select(_key(docs).alias("_key"), "text", F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("doc"))
    copy = F.row_number().over(Window.partitionBy("_key").orderBy(F.lit(0)))
    rows = rows.withColumn("_copy", copy).join(found, "_key")
    starts = F.array_distinct(F.transform("_draws", lambda x: x["start"]))
    rows = rows.withColumn("start", F.element_at(starts, F.col("_copy")))
    # the first piece ends where its block does, the others are whole blocks
    words = lambda n: F.concat(F.lit(r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){1,"), n,
                               F.lit(r"}(?:[\x20\x09-\x0D]++\z)?"))
    head = F.regexp_substr("text", words((block - F.col("start") % block).cast("string")))
    rows = rows.select("start", "doc", "text", "_draws", head.alias("_head"))
    rest = F.regexp_extract_all(F.expr("substring(text, length(_head) + 1)"), words(F.lit(str(block))), F.lit(0))
    rows = rows.select("start", "doc", "_draws", F.concat(F.array("_head"), rest).alias("_pieces"))
    mine = F.filter("_draws", lambda x: (x["start"] == F.col("start")) & x["shard"].isNotNull())
    at = lambda x: (x["block"] - _int_div(F.col("start"), block) + 1).cast("int")
    slot = F.transform(mine, lambda x: F.struct(
        x["shard"].alias("shard"), x["place"].alias("place"), x["sid"].alias("sid"), x["block"].alias("block"),
        F.element_at(F.col("_pieces"), at(x)).alias("text"), (at(x) == F.size("_pieces")).alias("ends")))
    return (rows.select("start", "doc", F.explode(slot).alias("s")).select("s.*", "start", "doc")
            .repartition("shard").sortWithinPartitions("shard", "place", "start"))


def mix_counts(docs: DataFrame, seed: int = 0, block: int = BLOCK, repeats: int = REPEATS) -> DataFrame:
    """What the mix takes of every document, counted in the join that makes the mix.

    One row per row of ``docs``: ``doc_id``, ``size``, ``source``, ``source_size``, ``target``, ``taken`` (words, each
    as often as the mix repeats it).  Null texts have no word; null sources are one source, the last; repeated rows
    are documents of their own; an empty table gives no row.  Reruns agree.
    """
    _, narrow, sizes, sources = _plan(docs, seed, block, repeats)
    placed = stored(positions(narrow, sizes, sources).select("sid", "start", "doc_id", "size"), "mix-places")
    found = drawn(placed.select("sid", "start", "size"), sources, seed, block).where("shard is not null")
    taken = found.groupBy("sid", "start").agg(F.sum("words").alias("taken"))
    about = sources.select("sid", "source", "source_size", "target")
    # a document without words may start where another one does
    words = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long")
    return (placed.join(taken, ["sid", "start"], "left").join(about, "sid")
            .select("doc_id", "size", "source", "source_size", "target", words.alias("taken")))


def mix_documents(docs: DataFrame, seed: int = 0, block: int = BLOCK, repeats: int = REPEATS,
                  marked: bool = False) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: the pieces of ``mix``, by shard and place.

    A document comes once for every slot that holds words of it, its ``text`` cut to them, and ``n_chars`` set to the
    new length if there is such a column.  With ``marked``, ``n_chars`` is null for a piece that its document goes on
    behind, so that who reads the corpus knows where documents end.
    """
    size = F.length("text").cast("long")
    new = {"text": F.col("text"), "n_chars": F.when(F.col("ends"), size) if marked else size}
    pieces = mix(docs, seed, block, repeats, max(1, SHARD_BLOCKS * BLOCK // block))
    return pieces.select([(new[c] if c in new else F.col("doc")[c]).alias(c) for c in docs.columns])


def sql(documents: str = "documents", seed: int = 0) -> str:
    """DuckDB SQL for the rows of ``mix_counts`` (the draws through the permutations run backwards)."""
    number = lambda text, digits: f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"
    back = f"""list_reduce(range({ROUNDS - 1}, -1, -1), lambda x, r:
        CASE WHEN (greatest(x, (keys[e + 1][r + 1].k + blocks - x) % blocks) % {PRIME} * keys[e + 1][r + 1].a)
                  % {PRIME} * 2 >= {PRIME} THEN (keys[e + 1][r + 1].k + blocks - x) % blocks ELSE x END, b)"""
    key = lambda kind: number(f"'{kind}:{seed}:' || sid || ':' || e || ':' || r", 12)
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
         md5(coalesce(text, '')) AS ord,
         {number("coalesce(CAST(doc_id AS VARCHAR), '')", 8)}
           % (SELECT greatest(1, CAST(ceil(count(*) / {BUCKET_ROWS}.0) AS BIGINT)) FROM {documents}) AS bucket
  FROM {documents}),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM s0),
s2 AS (SELECT *, CAST((sid - 1) % 3 + 1 AS DOUBLE) AS weight FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum({REPEATS} * source_size) OVER (ORDER BY source_size / weight,
                  sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (ORDER BY source_size / weight, sid
                                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s2),
s4 AS (SELECT *, {REPEATS} * source_size < level * weight AS stops FROM s3),
s5 AS (SELECT *, CASE WHEN stops THEN CAST({REPEATS} * source_size AS DOUBLE) ELSE least(weight * (
         SELECT level FROM s4 WHERE NOT stops ORDER BY source_size / weight, sid LIMIT 1),
         CAST({REPEATS} * source_size AS DOUBLE)) END AS target,
         (source_size + {BLOCK - 1}) // {BLOCK} AS blocks FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size * blocks + 0.5) AS BIGINT),
         {REPEATS} * blocks) ELSE 0 END AS slots FROM s5),
s7 AS (SELECT *, list_transform(range(0, {REPEATS}), lambda e: list_transform(range(0, {ROUNDS}), lambda r:
         struct_pack(k := {key('k')} % greatest(blocks, 1), a := 1 + {key('a')} % {PRIME - 1}))) AS keys FROM s6),
placed AS (
  SELECT d.doc_id, d.size, s7.*, coalesce(sum(d.size) OVER (PARTITION BY sid ORDER BY bucket, doc_id NULLS FIRST, ord,
    size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized d JOIN s7 ON d.source IS NOT DISTINCT FROM s7.source),
parts AS (
  SELECT sid, start, doc_id, size, source, source_size, target, blocks, slots, keys, b,
         least(start + size, (b + 1) * {BLOCK}) - greatest(start, b * {BLOCK}) AS words
  FROM (SELECT *, unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) AS b FROM placed WHERE size > 0)),
drawn AS (
  SELECT *, list_sum(list_transform(range(0, {REPEATS}), lambda e:
         CASE WHEN e * blocks + {back} < slots THEN 1 ELSE 0 END)) AS n FROM parts)
SELECT doc_id, size, source_size, target, CAST(sum(words * n) AS BIGINT) AS taken
FROM drawn GROUP BY sid, start, doc_id, size, source_size, target
UNION ALL SELECT doc_id, size, source_size, target, 0 FROM placed WHERE size = 0
"""
