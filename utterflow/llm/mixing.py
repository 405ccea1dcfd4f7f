"""Mix sources to target weights by drawing fixed-length blocks of words.

1. The words of a source are laid end to end and cut into blocks of ``block_words``.
2. Every output shard has ``shard_slots`` slots. Its source counts are a multinomial draw, under the
   condition that the shards add up to the targets (a multivariate hypergeometric draw).
3. The slots of a source are numbered through all shards. Slot j takes block ``perm(j mod n)`` in
   pass ``j div n``; ``perm`` is a keyed Feistel permutation of the source's n block numbers.
4. Texts go once to the (source, bucket) in which they lie, as do the slots of the blocks there.
   Texts are cut into pieces where blocks end, and pieces are gathered with the slots by block
   number, which gives the mixed text; the slots of all sources are permuted by the draw. A block
   that begins in one bucket and ends in another is put together from its parts. What the mix takes
   of a document is counted from these blocks.

A block is taken at most ``cap`` times, and so is every word of every document. All of it is
DataFrame functions; prefix sums go through buckets, so no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterflow.llm.tables import Stored, words

WEIGHTS = (5, 2, 1)
BUCKETS = 4096
FEISTEL_ROUNDS = 6
# Slots that one row becomes at a time.
SLOTS_PER_ROW = 8192


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 3) -> DataFrame:
    """Targets of a table ``(source, source_size)`` with one row per source.

    Adds ``source_id`` (place by code point, null last), ``weight`` and ``target``. A target is
    min(cap * size, level * weight); the level is where they add up to all sizes. With the sources
    in order of cap * size / weight, those before some place are at their cap, which gives the
    level by running sums. The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1).cast("long")
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    full = F.col("source_size") * cap
    ratio = Window.orderBy(full / F.col("weight"), "source_id")
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = sizes.withColumns({"source_id": place}).withColumn("weight", weight.cast("double"))
    levels = ranked.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(before), F.lit(0)))
        / (
            F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
        ),
    )
    # The first source in this order whose cap is above the level there fixes it for all.
    open_level = F.min(F.when(full >= F.col("level") * F.col("weight"), F.struct("level_at", "level")))
    levels = levels.withColumn("level_at", F.row_number().over(ratio)).withColumn(
        "final", open_level.over(everything)["level"]
    )
    target = F.least(full.cast("double"), F.col("final") * F.col("weight"))
    return levels.select(
        "source", "source_size", "source_id", "weight", target.cast("double").alias("target")
    )


def permuted(index: Column, size: Column, key: Column) -> Column:
    """A keyed permutation of 0 .. size - 1: Feistel steps on a grid, walking on if outside.

    The grid has ``a`` columns and ``b`` rows with a * b >= size and fewer than ``a`` cells over,
    so almost every index is inside at once; the others walk along their cycle. For many rows,
    ``with_permuted`` does the same.
    """
    a, b = _grid(size)
    return _inside(_step(index, a, b, key), size, a, b, key)


def with_permuted(rows: DataFrame, name: str, index: Column, size: Column, key: Column) -> DataFrame:
    """``rows`` with the column ``name``: ``permuted`` of their ``index``.

    A column per half round, which Spark compiles, where the rounds of an aggregate over an array
    are interpreted. Only the few indices that are outside at first walk on in that way. Store the
    rows before they are joined or filtered by ``name``: a filter on it, also that of a join for
    values that are not null, is written out in terms of ``index``, twice as long per half round.
    """
    own = ("__size", "__key", "__a", "__b", "__l", "__r", "__first")
    size_, key_, a, b, left, right, first = map(F.col, own)
    grid = rows.withColumns({"__size": size, "__key": key, "__first": index})
    grid = grid.withColumn("__a", _grid(size_)[0]).withColumn("__b", F.ceil(size_ / a).cast("long"))
    cells = grid.withColumns({"__l": F.pmod(first, a), "__r": F.floor(first / a).cast("long")})
    for k in range(1, FEISTEL_ROUNDS + 1):
        cells = cells.withColumn("__l", F.pmod(left + F.pmod(F.xxhash64(key_, F.lit(k), right), a), a))
        cells = cells.withColumn("__r", F.pmod(right + F.pmod(F.xxhash64(key_, F.lit(-k), left), b), b))
    placed = cells.withColumn("__first", left + a * right)
    return placed.withColumn(name, _inside(first, size_, a, b, key_)).drop(*own)


def _grid(size: Column) -> tuple[Column, Column]:
    a = F.greatest(F.ceil(F.sqrt(size.cast("double"))), F.lit(1)).cast("long")
    return a, F.ceil(size / a).cast("long")


def _step(x: Column, a: Column, b: Column, key: Column) -> Column:
    state = F.struct(F.pmod(x, a).alias("l"), F.floor(x / a).cast("long").alias("r"))
    rounds = F.sequence(F.lit(1), F.lit(FEISTEL_ROUNDS))

    def one(s: Column, k: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(F.xxhash64(key, k, s["r"]), a), a)
        right = F.pmod(s["r"] + F.pmod(F.xxhash64(key, -k, left), b), b)
        return F.struct(left.alias("l"), right.alias("r"))

    return F.aggregate(rounds, state, one, lambda s: s["l"] + a * s["r"])


def _inside(first: Column, size: Column, a: Column, b: Column, key: Column) -> Column:
    """A cell of the grid, or the first one inside on its cycle."""
    walk = F.aggregate(
        F.sequence(F.lit(0).cast("long"), a * b - size),
        first,
        lambda x, _: F.when(x < size, x).otherwise(_step(x, a, b, key)),
    )
    return F.when(first < size, first).otherwise(walk)


def sized_documents(docs: DataFrame) -> DataFrame:
    """The words of every text, joined by blanks, as ``text``, with their number and place.

    Columns ``doc_id, source, text, size, digest, source_key, bucket``. ``source_key`` is the source,
    told from a missing one and never null, so that windows and joins deal rows out alike.
    """
    own = docs.select("doc_id", "source", words(F.col("text")).alias("own"))
    texts = own.select(
        "doc_id", "source", F.array_join("own", " ").alias("text"), F.size("own").cast("long").alias("size")
    )
    # The digest spreads rows without an id, and orders rows with equal ids by their words.
    return texts.withColumn("digest", F.xxhash64("text")).withColumns(
        {
            "source_key": F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")),
            # Never null in Spark's eyes: else a join on it filters by it first, from the texts anew.
            "bucket": F.coalesce(F.pmod(F.xxhash64("doc_id", "digest"), F.lit(BUCKETS)), F.lit(0)).cast("int"),
        }
    )


class Mix:
    """A mix of ``docs``, of which ``doc_id, source, text`` are read.

    ``blocks`` is the mixed text. ``placed`` has every row of ``docs`` with its place in its source.
    """

    def __init__(
        self,
        docs: DataFrame,
        block_words: int = 128,
        shard_slots: int = 8192,
        cap: int = 3,
        seed: int = 17,
    ):
        texts = sized_documents(docs)
        sized = Stored(texts.drop("text"), "sizes").table
        of_bucket = sized.groupBy("source", "source_key", "bucket").agg(F.sum("size").alias("bucket_size"))
        sizes = of_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
        sources = Stored(
            source_targets(sizes)
            .withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
            .withColumn(
                # A short last block makes the average block of a source smaller.
                "wanted",
                F.when(
                    F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")
                ).otherwise(0.0),
            ),
            "sources",
        ).table
        by_bucket = Window.partitionBy("source").orderBy("bucket")
        starts = of_bucket.withColumn(
            "bucket_start", F.sum("bucket_size").over(by_bucket) - F.col("bucket_size")
        ).join(
            sources.select(F.col("source").alias("s"), "source_id", "source_size", "target"),
            F.col("source").eqNullSafe(F.col("s")),
        )
        starts = Stored(
            starts.select(
                F.col("source_key").alias("s"),
                F.col("bucket").alias("b"),
                "bucket_start",
                "bucket_size",
                "source_id",
                "source_size",
                "target",
            ),
            "starts",
        ).table
        self.placed = _placed(sized, starts)
        # Spark takes tables that explode makes for as few as what they are made from: without the
        # hints it would broadcast them.
        drawn = Stored(_slots(sources, shard_slots, cap, seed), "slots").table
        slots = drawn.join(_covers(starts, block_words).hint("merge"), ["source_id", "block"])
        slots = slots.groupBy("source_key", "bucket", "block").agg(
            F.collect_list(F.struct("shard", "slot")).alias("slots"), F.first("shared").alias("shared")
        )
        # The one shuffle of the texts; what follows stays in their (source, bucket).
        rows = texts.unionByName(slots.withColumn("size", F.lit(0).cast("long")), allowMissingColumns=True)
        pieces = _pieces(_placed(rows, starts), block_words)
        held = pieces.groupBy("source_key", "bucket", "source_id", "block").agg(
            F.array_sort(F.collect_list("piece")).alias("pieces"),
            F.first("source", True).alias("source"),
            F.first("slots", True).alias("slots"),
            F.first("shared", True).alias("shared"),
        )
        parts = held.select(
            "source",
            "source_id",
            "block",
            "shared",
            F.array_join(F.transform("pieces", lambda p: p["text"]), " ").alias("text"),
            F.transform("pieces", lambda p: p.dropFields("text")).alias("pieces"),
            F.inline("slots"),
        )
        self.blocks = _whole(Stored(parts, "blocks").table)

    def taken(self) -> DataFrame:
        """``doc_id, size, source_size, target, taken`` per row, counted from ``blocks``."""
        piece = self.blocks.select("source_id", F.explode("pieces").alias("p"))
        sums = piece.groupBy("source_id", F.col("p.start").alias("at")).agg(
            F.sum("p.n_words").alias("taken")
        )
        # Rows with words have a place of their own; those without have none.
        rows = self.placed.withColumn("at", F.when(F.col("size") > 0, F.col("start")))
        return rows.join(sums.hint("merge"), ["source_id", "at"], "left").select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )


def mixed_blocks(docs: DataFrame, **options: int) -> DataFrame:
    """The mixed text: a row per filled slot, each shard in one task and in the order of its slots.

    Columns ``shard, slot, source, source_id, block, text, pieces``: ``text`` has the words of the
    block, joined by blanks; ``pieces`` says from which rows they are, as ``start`` (of the row in
    its source), ``doc_id`` and ``n_words``. Options are those of ``Mix``.
    """
    blocks = Mix(docs, **options).blocks
    return blocks.repartition("shard").sortWithinPartitions("shard", "slot")


def mixed(docs: DataFrame, **options: int) -> DataFrame:
    """How many words of each document the mix takes, counted from the mixed blocks.

    Returns ``doc_id, size, source_size, target, taken``; one row per row of ``docs``. Documents
    without words take none; rows with equal ids are laid end to end like any others. Options are
    those of ``Mix``.
    """
    return Mix(docs, **options).taken()


def _placed(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows of ``sized_documents`` with ``start``, the place of their first word in the source."""
    inside = Window.partitionBy("source_key", "bucket").orderBy("doc_id", "size", "digest")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, (F.col("source_key") == F.col("s")) & (F.col("bucket") == F.col("b")))
        .withColumn("start", F.col("bucket_start") + F.col("before"))
    )


def _pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """The words of each text, cut where blocks end, a row per ``block`` and ``piece``.

    Rows of slots have no words and come through with their block.
    """
    start, end = F.col("start"), F.col("start") + F.col("size")
    first = F.floor(start / block_words).cast("long")
    last = F.floor((end - 1) / block_words).cast("long")

    def cut(own: Column, block: Column) -> Column:
        low = F.greatest(start, block * block_words)
        n = (F.least(end, (block + 1) * block_words) - low).cast("int")
        text = F.array_join(F.slice(own, (low - start + 1).cast("int"), n), " ")
        piece = F.struct(
            start.alias("start"), F.col("doc_id").alias("doc_id"), n.cast("long").alias("n_words"),
            text.alias("text"),
        )
        return F.struct(block.alias("block"), piece.alias("piece"))

    # As the variable of a function the words are split once per text, not once per block.
    cuts = F.transform(
        F.array(F.split("text", " ")),
        lambda own: F.transform(F.sequence(first, last), lambda block: cut(own, block)),
    )
    cuts = F.when(F.col("size") > 0, F.flatten(cuts))
    kept = ("source_key", "bucket", "source_id", "source", "slots", "shared")
    rows = placed.where("size > 0 OR slots IS NOT NULL").select(*kept, "block", F.explode_outer(cuts).alias("c"))
    return rows.select(*kept, F.coalesce("c.block", "block").alias("block"), "c.piece")


def _covers(starts: DataFrame, block_words: int) -> DataFrame:
    """``(source_id, block, source_key, bucket, shared)``: the blocks with words in each bucket.

    A ``shared`` block has words in other buckets, too.
    """
    low, high = F.col("bucket_start"), F.col("bucket_start") + F.col("bucket_size")
    first, last = (F.floor(at / block_words).cast("long") for at in (low, high - 1))
    begin = F.col("block") * block_words
    end = F.least(begin + block_words, F.col("source_size"))
    rows = starts.where("bucket_size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    return rows.select(
        "source_id",
        "block",
        F.col("s").alias("source_key"),
        F.col("b").alias("bucket"),
        ((begin < low) | (end > high)).alias("shared"),
    )


def _whole(parts: DataFrame) -> DataFrame:
    """Blocks from their parts: only those that buckets share have several."""
    names = ["shard", "slot", "source", "source_id", "block", "text", "pieces"]
    part = F.struct(F.col("pieces")[0]["start"].alias("start"), "text", "pieces")
    joined = (
        parts.where("shared")
        .groupBy("shard", "slot", "source", "source_id", "block")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .withColumn("text", F.array_join(F.transform("parts", lambda p: p["text"]), " "))
        .withColumn("pieces", F.flatten(F.transform("parts", lambda p: p["pieces"])))
    )
    return parts.where("NOT shared").select(*names).unionByName(joined.select(*names))


def drawn_slots(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """``(source_id, blocks, nth, shard, slot)``: the slots that each source gets, numbered by ``nth``.

    A source gets its ``wanted`` slots, to the nearest number of the running sum. All slots are laid
    end to end by source and permuted, and cut into shards: what a shard has of each source is a
    multinomial draw under the condition that the shards add up to these numbers.
    """
    upto = F.sum("wanted").over(Window.orderBy("source_id").rowsBetween(Window.unboundedPreceding, 0))
    ends = sources.withColumn("high", F.floor(upto + 0.5).cast("long"))
    ends = ends.withColumns(
        {
            "low": F.coalesce(F.lag("high").over(Window.orderBy("source_id")), F.lit(0).cast("long")),
            "total": F.max("high").over(Window.partitionBy()),
        }
    ).where("high > low AND blocks > 0")
    size = F.lit(SLOTS_PER_ROW)
    chunks = F.sequence(F.floor(F.col("low") / size), F.floor((F.col("high") - 1) / size))
    rows = ends.select("source_id", "blocks", "low", "high", "total", F.explode(chunks).alias("chunk"))
    # A few rows by now; spread over tasks before each becomes thousands of slots.
    n_tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n_tasks, "source_id", "chunk")
    first = F.greatest("low", F.col("chunk") * size)
    last = F.least("high", (F.col("chunk") + 1) * size) - 1
    slots = rows.select("source_id", "blocks", "low", "total", F.explode(F.sequence(first, last)).alias("at"))
    slots = with_permuted(
        slots, "place", F.col("at"), F.col("total"), F.xxhash64(F.lit(seed), F.lit("slots"))
    ).withColumn("nth", F.col("at") - F.col("low"))
    return slots.select(
        "source_id",
        "blocks",
        "nth",
        F.floor(F.col("place") / shard_slots).cast("long").alias("shard"),
        (F.col("place") % shard_slots).alias("slot"),
    )


def shard_counts(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """``(source_id, shard, slots)``: how many slots each shard has drawn from each source."""
    drawn = drawn_slots(sources, shard_slots, seed)
    return drawn.groupBy("source_id", "shard").agg(F.count(F.lit(1)).alias("slots"))


def _slots(sources: DataFrame, shard_slots: int, cap: int, seed: int) -> DataFrame:
    """``(source_id, block, shard, slot)``: the block in each slot."""
    slots = drawn_slots(sources, shard_slots, seed).where(
        F.col("nth") < F.col("blocks") * cap  # rounding may draw a slot beyond the cap
    )
    key = F.xxhash64(F.lit(seed), "source_id", F.floor(F.col("nth") / F.col("blocks")))
    slots = with_permuted(slots, "block", F.col("nth") % F.col("blocks"), F.col("blocks"), key)
    return slots.select("source_id", "block", "shard", "slot")
