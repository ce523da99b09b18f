"""Mixing sources to target weights, with DataFrame operations only.

Words of a source are one stream, its documents one after another, cut into blocks of BLOCK words
(the last one may be shorter). The mix is filled shard by shard: every output shard draws how many
of its slots each source gets, with the sources' shares as probabilities. The draw is the
multinomial one by systematic sampling: one random number a shard, so a source's count has the
right mean and differs from it by less than 1. A source's slots are numbered over all shards, and
a pseudorandom permutation of the source's block numbers (another one for every time through
the source) says which block fills a slot. Blocks and draws are joined by source and slot number.
Another permutation, of a shard's slots, deals its sources' slots out over the shard.

The permutation is the swap-or-not shuffle: in every round, a number and its mirror image about a
keyed centre change places or not, by a keyed bit that is the same for both. It is a permutation
of 0 .. n - 1 for any n, without walks or rejects, and its rounds backwards are its inverse: a block's
row finds the (at most MOST_TIMES) slots that the block fills, and no slot is listed to find its block.
Rounds are columns of their own, so that they are compiled.

``mixed`` makes the mix itself: for every slot the words of its block, cut out of the documents that
they stand in, with the places they were cut from. ``taken`` is added up from these places, as they
were written. A text moves once to its cuts, and cut words once to their shard. In between the cut words are
written, compressed, to the scratch folder, so that the shuffle files of the first move go before the second, which is
made in PASSES passes over the shards: what lies on disk at once is one move's files or a pass's, not both moves'.

A source's stream is numbered piece by piece, an id's documents by size, and documents of one id and size
in parts; equal rows are one row with a number of copies until they are cut, and their text
moves once for COPIES of them. So neither a source, an id (or null) nor a repeated row with a third of all
rows is one task's work. All arithmetic is on whole numbers or on sums over sources
in a fixed order, so reruns agree.

Defined results. A null or empty text has size 0 and is never taken. A null source is a source, the
last one. A source without words has target 0. A source's slots beyond 3 times through its blocks
are left out, so no document is taken more than 3 times. Repeated rows are documents of their own;
null ids come first in the order of their source. An empty table gives an empty table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import PREFIX_PIECES, dealt, fresh, prefix_sum, release, stored
from quire.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block, slots of an output shard (a million words).
BLOCK, SHARD_SLOTS = 64, 16384
#: The weights of the sources in order, repeating; how often a document may be taken.
WEIGHTS, MOST_TIMES = 3, 3
SEED, ROUNDS = 20240229, 16
PRIME = 2147483647
#: Of the pseudorandom numbers: bits that change places with multiplications modulo PRIME.
MASKS, FACTORS = (715827882, 1431655765), (1103515245, 1812433253)
#: A table of up to so many sources (about 60 bytes each) is sent to all tasks; a larger one is joined.
SOURCES_TO_SEND = 100_000
#: A table of up to so many draws (about 100 bytes each) is sent to all tasks; a larger one is joined.
DRAWS_TO_SEND = 200_000
#: Equal rows that share a move of their text.
COPIES = 64
#: Words of the documents that one task numbers; rounds that are compiled into one piece of code.
WORDS_A_TASK, ROUNDS_A_STEP = 2_000_000, 4
#: Neighbouring slots of a shard that are written by one task, in order.
RUN_SLOTS = 256
#: What tells texts apart: doc_id (0 and true for null), and a hash of text and source.
TEXT_KEY = ["id", "no_id", "same"]
#: Folder for the mix of the pipeline; without it, one in the scratch folder.
MIX_PATH = "quire.mix.path"
#: How hard the mix and the cut words before it are compressed (zstd).
MIX_LEVEL, CUT_LEVEL = 6, 3
#: Passes over the output shards in which the cut words move.
PASSES = 2


def stirred(x: str) -> str:
    """``x`` with its bits mixed once more, as an expression in text: many columns are made of it, and
    text is parsed faster than Columns are put together."""
    for mask, factor in zip(MASKS, FACTORS):
        x = f"((({x}) ^ {mask}L) * {factor}) % {PRIME}"
    return x


def scattered(*keys: str) -> str:
    """A pseudorandom number 0 .. PRIME - 1 of whole numbers; products stay below 2^63."""
    y = f"{SEED % PRIME}L"
    for k in keys:
        y = stirred(f"({y} + (CAST({k} AS BIGINT) % {PRIME}) * {FACTORS[0]}) % {PRIME}")
    return y


def round_keys(*keys: str) -> Column:
    """The keys of the rounds of one permutation."""
    return F.expr("array(" + ", ".join(scattered(*keys, str(r)) for r in range(1, ROUNDS + 1)) + ")")


def with_permuted(df: DataFrame, x: str, n: str, keys: str, inverse: bool = False) -> DataFrame:
    """``x`` replaced by its place in the permutation of 0 .. n - 1, or by what has it as its place. In
    a round ``x`` becomes its mirror image or not, by a bit that is the same for both.

    A round's columns are used several times by the next, so they are not put into one expression; the explode
    at the end keeps a filter on ``x`` from being pushed down through them, which would do that. After a few
    rounds a lambda, which is not compiled, ends a piece of code: the JVM only interprets long ones."""
    rounds = list(reversed(range(ROUNDS)) if inverse else range(ROUNDS))
    for k, r in enumerate(rounds, 1):
        key = f"{keys}[{r}]"
        df = df.withColumn("__mirror", F.expr(f"pmod({key} % {n} - {x}, {n})"))
        bit = f"shiftright({stirred(f'(greatest({x}, __mirror) + {key}) % {PRIME}')}, 10) & 1L"
        df = df.withColumn(x, F.expr(f"CASE WHEN ({bit}) = 1 THEN __mirror ELSE {x} END"))
        if k % ROUNDS_A_STEP == 0:
            df = df.withColumn(x, F.transform(F.array(x), lambda y: y)[0])
    return df.drop("__mirror").withColumn(x, F.explode(F.array(F.col(x))))


def sources(rows: DataFrame) -> DataFrame:
    """One row a source: its number (rank) in code point order, words, target in words, blocks, the
    shares before and up to it of all ``n_slots`` slots, and its usual draw in a shard (``width``). Targets fill up by weight; the sources
    that are full are those whose 3 sizes are reached first, in the order of size by weight."""
    every = Window.partitionBy()
    up_to = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    order = Window.orderBy(F.asc_nulls_last("source"))
    full_first = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("rank", F.row_number().over(order).cast("long"))
    s = s.withColumn("weight", (F.col("rank") - 1) % WEIGHTS + 1)
    cap = F.col("source_size") * MOST_TIMES
    s = (s.withColumn("all_words", F.sum("source_size").over(every))
         .withColumn("left", F.col("all_words") - F.sum(cap).over(up_to(full_first)) + cap)
         .withColumn("weights", F.sum("weight").over(every) - F.sum("weight").over(up_to(full_first)) + F.col("weight"))
         .withColumn("full", cap * F.col("weights") <= F.col("left") * F.col("weight"))
         .withColumn("spare", F.col("all_words") - F.coalesce(F.sum(F.when(F.col("full"), cap)).over(every), F.lit(0)))
         .withColumn("sharing", F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("weight"))).over(every)))
    s = s.withColumn("target", F.when(F.col("full"), cap.cast("double"))
                     .otherwise((F.col("spare") * F.col("weight")).cast("double") / F.col("sharing").cast("double")))
    s = s.withColumn("n_blocks", F.floor((F.col("source_size") + (BLOCK - 1)) / BLOCK).cast("long"))
    # a source whose last block is short needs a few slots more for its target
    wanted = F.when(F.col("source_size") > 0, F.col("target") * F.col("n_blocks") / F.col("source_size")).otherwise(F.lit(0.0))
    in_order = Window.orderBy("rank")
    s = s.withColumn("wanted", wanted).withColumn("to", F.sum("wanted").over(up_to(in_order)))
    s = s.withColumn("from", F.coalesce(F.lag("to").over(in_order), F.lit(0.0))).withColumn("all", F.max("to").over(every))
    s = s.withColumn("n_slots", F.floor(F.col("all") + 0.5).cast("long"))
    s = s.select("source", "rank", "source_size", "target", "n_blocks", "n_slots",
                 F.when(F.col("all") > 0, F.col("from") / F.col("all")).otherwise(0.0).alias("share_from"),
                 F.when(F.col("all") > 0, F.col("to") / F.col("all")).otherwise(0.0).alias("share_to"))
    usual = F.greatest(F.lit(1), F.floor(SHARD_SLOTS * (F.col("share_to") - F.col("share_from")))).cast("long")
    return s.withColumn("width", usual)


def draws(s: DataFrame) -> DataFrame:
    """One row for every shard and source that it draws: ``n_drawn`` slots, numbered from ``first``
    among the source's slots, after ``offset`` slots of other sources in the shard. Shard numbers are made in two steps, so no array is long."""
    n_shards = F.ceil(F.col("n_slots") / SHARD_SLOTS)
    many = s.where("n_slots > 0 and n_blocks > 0").withColumn("hi", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n_shards - 1) / 1024))))
    many = many.withColumn("shard", F.explode(F.sequence(F.col("hi") * 1024, F.least(F.col("hi") * 1024 + 1023, n_shards - 1))))
    slots = F.least(F.lit(SHARD_SLOTS).cast("long"), F.col("n_slots") - F.col("shard") * SHARD_SLOTS)
    u = F.expr(scattered("1", "shard")).cast("double") / F.lit(float(PRIME))
    drawn = (F.floor(slots.cast("double") * F.col("share_to") + u) - F.floor(slots.cast("double") * F.col("share_from") + u)).cast("long")
    offset = F.floor(slots.cast("double") * F.col("share_from") + u).cast("long")
    many = many.select("source", "rank", "n_blocks", "width", "shard", slots.alias("shard_slots"), offset.alias("offset"), drawn.alias("n_drawn"), (F.col("shard") % PREFIX_PIECES).alias("piece"))
    return prefix_sum(many, ["rank"], ["shard"], "n_drawn", "first", "piece").where("n_drawn > 0")


def sent(table: DataFrame, rows: int, most: int) -> DataFrame:
    """``table`` of so many rows for a join: to all tasks up to ``most`` rows, else by merging."""
    return F.broadcast(table) if rows <= most else table.hint("merge")


def numbered(groups: DataFrame) -> DataFrame:
    """From groups of equal rows (source, doc_id, size, same, copies) of ids with several rows, beside
    ``start``, where the id begins: ``start`` of each group. An id's rows go by size, and those of a size
    part by part, by their hash."""
    key, size_key = ["source", "doc_id"], ["source", "doc_id", "size"]

    def beside(left: DataFrame, right: DataFrame, on: list[str], column: str) -> DataFrame:
        right = right.select(*[F.col(c).alias(f"__{c}") for c in on], column).hint("merge")
        match = [left[c].eqNullSafe(right[f"__{c}"]) for c in on]
        return left.join(right, match).drop(*[f"__{c}" for c in on])

    rows = groups.withColumn("part", F.pmod("same", F.lit(PREFIX_PIECES)).cast("int"))
    parts = rows.groupBy(*size_key, "part").agg(F.sum("copies").alias("n"))
    sizes = parts.groupBy(*size_key).agg((F.sum("n") * F.col("size")).alias("words"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("earlier", F.coalesce(F.sum("words").over(before(Window.partitionBy(*key).orderBy("size"))), F.lit(0)))
    parts = parts.withColumn("ahead", F.coalesce(F.sum("n").over(before(Window.partitionBy(*size_key).orderBy("part"))), F.lit(0)) * F.col("size"))
    parts = beside(parts, sizes, size_key, "earlier").withColumn("offset", F.col("earlier") + F.col("ahead"))
    rows = rows.withColumn("own", F.coalesce(F.sum("copies").over(before(Window.partitionBy(*size_key, "part").orderBy("same"))), F.lit(0)) * F.col("size"))
    rows = beside(rows, parts, [*size_key, "part"], "offset")
    return rows.withColumn("start", F.col("start") + F.col("offset") + F.col("own")).drop("part", "offset", "own")


def packed(rows: DataFrame) -> DataFrame:
    """(source, doc_id, size, same, copies, start): equal rows of ``sized`` as one, with the words of their
    source before the first of them. A source goes piece by piece, by doc_id and size."""
    groups = rows.groupBy("source", "doc_id", "size", "same").agg(F.count("*").alias("copies"))
    ids = groups.groupBy("source", "doc_id").agg(F.count("*").alias("kinds"), F.sum(F.col("size") * F.col("copies")).alias("words"), F.min("size").alias("size"),
                                                 F.min("same").alias("same"), F.min("copies").alias("copies"))
    ids = ids.withColumn("piece", F.coalesce(F.pmod(F.col("doc_id").cast("long"), F.lit(PREFIX_PIECES)), F.lit(0)))
    ids = stored(prefix_sum(ids, ["source"], [F.asc_nulls_first("doc_id")], "words", "start", "piece"))
    columns = ["source", "doc_id", "size", "same", "copies", "start"]
    one = ids.where("kinds = 1").select(*columns)
    # the rows of an id are dealt to parts before they meet its start, so that no id is one task's work
    part = F.pmod("same", F.lit(PREFIX_PIECES)).cast("int")
    many = ids.where("kinds > 1").select(F.col("source").alias("m_source"), F.col("doc_id").alias("m_id"), "start")
    having = groups.select("source", "doc_id", part.alias("part")).distinct()
    having = having.join(many.hint("merge"), having["source"].eqNullSafe(many["m_source"]) & having["doc_id"].eqNullSafe(many["m_id"]))
    having = having.select("m_source", "m_id", F.col("part").alias("m_part"), "start")
    groups = groups.withColumn("part", part)
    on = groups["source"].eqNullSafe(having["m_source"]) & groups["doc_id"].eqNullSafe(having["m_id"]) & (groups["part"] == having["m_part"])
    several = numbered(groups.join(having.hint("merge"), on).drop("m_source", "m_id", "m_part", "part"))
    return one.unionByName(several.select(*columns))


def copied(groups: DataFrame) -> DataFrame:
    """One row for each row of the table: ``copy`` numbers equal rows, ``part`` is copy / COPIES. Groups
    with many copies are dealt out before they become rows."""
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES)))
    few = groups.where(F.col("copies") <= COPIES).withColumn("part", F.lit(0).cast("long"))
    many = groups.where(F.col("copies") > COPIES).withColumn("part", parts).repartition("same", "part")
    last = F.least(F.col("copies"), (F.col("part") + 1) * COPIES) - 1
    rows = few.unionByName(many).withColumn("copy", F.explode(F.sequence(F.col("part") * COPIES, last)))
    return rows.withColumn("start", F.col("start") + F.col("copy") * F.col("size"))


def spans(placed: DataFrame) -> DataFrame:
    """One row for each block that a document has words in: ``words`` of them from ``from_word`` on.
    A document without words has one row, with block -1."""
    first, end = F.col("start"), F.col("start") + F.col("size")
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(first / BLOCK), F.floor((end - 1) / BLOCK))).otherwise(F.array(F.lit(-1).cast("long")))
    rows = placed.withColumn("block", F.explode(blocks))
    a, b = F.greatest(first, F.col("block") * BLOCK), F.least(end, F.col("block") * BLOCK + BLOCK)
    return rows.withColumn("from_word", a - first).withColumn("words", F.when(F.col("block") < 0, F.lit(0)).otherwise(b - a).cast("long"))


def text_hash() -> Column:
    return F.xxhash64("text", "source").alias("same")


def id_key() -> list[Column]:
    """doc_id without nulls, so that groups and joins are dealt out alike."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"), F.col("doc_id").isNull().alias("no_id")]


def text_key() -> list[Column]:
    """TEXT_KEY of a document."""
    return [*id_key(), text_hash()]


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and hash of every document."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), text_hash())


def slot_numbers(place: DataFrame, s: DataFrame, drawn: DataFrame, n_sources: int) -> DataFrame:
    """``place`` with rank, n_blocks, width and ``k``, the number of a slot that the block would fill among
    all of its source: one for each time through the source that its draws begin."""
    ends = drawn.groupBy(F.col("d_rank").alias("rank")).agg(F.max("end").alias("end"))
    passes = s.where("n_blocks > 0").join(ends, "rank").withColumn("time", F.explode(F.array(*[F.lit(t).cast("long") for t in range(MOST_TIMES)])))
    passes = passes.where(F.col("time") * F.col("n_blocks") < F.col("end"))
    passes = passes.select(F.col("source").alias("p_source"), "rank", "n_blocks", "time", "width",
                           round_keys("2", "rank", "time").alias("keys"))
    rows = place.join(sent(passes, n_sources, SOURCES_TO_SEND), place["source"].eqNullSafe(passes["p_source"])).withColumn("k", F.col("block"))
    rows = with_permuted(rows, "k", "n_blocks", "keys", inverse=True)
    return rows.withColumn("k", F.col("time") * F.col("n_blocks") + F.col("k")).drop("p_source", "time", "keys", "n_blocks")


def cuts(packs: DataFrame, s: DataFrame) -> DataFrame:
    """One row for each slot and document that has words in the slot's block: ``words`` of them from
    ``from_word`` on; ``begin`` is their place in the block.

    A source's slot numbers are cut into buckets of its usual draw in a shard, so a bucket meets few
    draws, and a draw few buckets."""
    n_sources = s.count()
    drawn = draws(s)
    drawn = stored(drawn.select(F.col("rank").alias("d_rank"), "shard", "shard_slots", "first", (F.col("first") + F.col("n_drawn")).alias("end"),
                                (F.col("offset") - F.col("first")).alias("lead"),
                                F.explode(F.sequence(F.floor(F.col("first") / F.col("width")), F.floor((F.col("first") + F.col("n_drawn") - 1) / F.col("width")))).alias("d_bucket")))
    packs = dealt(packs, s.agg(F.sum("source_size")).first()[0] or 0, WORDS_A_TASK)
    place = slot_numbers(spans(copied(packs)).where("block >= 0"), s, drawn, n_sources)
    place = place.withColumn("bucket", F.floor(F.col("k") / F.col("width")))
    index = sent(drawn, drawn.count(), DRAWS_TO_SEND)
    rows = place.join(index, (place["rank"] == drawn["d_rank"]) & (place["bucket"] == drawn["d_bucket"]) & (F.col("k") >= F.col("first")) & (F.col("k") < F.col("end")))
    begin = F.col("start") + F.col("from_word") - F.col("block") * BLOCK
    rows = rows.select("source", "doc_id", "same", "part", "copy", "copies", "shard", "shard_slots", "block", begin.alias("begin"), "from_word", "words",
                       (F.col("lead") + F.col("k")).alias("slot"), round_keys("3", "shard").alias("keys"))
    return with_permuted(rows, "slot", "shard_slots", "keys").drop("keys", "shard_slots")


def cut_words(docs: DataFrame, cut: DataFrame) -> DataFrame:
    """The rows of ``cuts`` with their words, cut out of the documents. Documents alike in id, source and text have
    one text; ``copy`` tells them apart, ``same`` (a hash of text and source) those of one id."""
    # a document's cuts are made by one task, so they are one row before they are shuffled
    each = F.struct("copy", "shard", F.col("slot").cast("int").alias("slot"), "block", F.col("begin").cast("int").alias("begin"), "from_word", F.col("words").cast("int").alias("words"))
    lists = cut.groupBy(*id_key(), "same", "part", "doc_id", "source", "copies").agg(F.collect_list(each).alias("cuts"))
    texts = docs.select(*text_key(), "text").groupBy(*TEXT_KEY).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    few, many = F.col("copies") <= COPIES, F.col("copies") > COPIES
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES)))
    # the texts of many equal rows move again, to the parts of their copies
    joined = lists.where(few).drop("copies").join(texts.where(few).drop("copies").hint("merge"), TEXT_KEY).unionByName(
        lists.where(many).drop("copies").join(texts.where(many).withColumn("part", parts).drop("copies").hint("merge"), [*TEXT_KEY, "part"]))

    def sliced(words: Column) -> Column:
        return F.transform("cuts", lambda c: F.struct(
            *[c[x].alias(x) for x in ("copy", "shard", "slot", "block", "begin", "from_word", "words")],
            F.array_join(F.slice(words, (c["from_word"] + 1).cast("int"), c["words"]), " ").alias("text")))

    # the array around the words has them split once for all cuts
    found = F.transform(F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), sliced)[0]
    return joined.select("source", "doc_id", "same", F.explode(found).alias("c")).select("source", "doc_id", "same", "c.*")


def blocks(rows: DataFrame) -> DataFrame:
    """The mix of the rows of ``cut_words``: (shard, slot, source, block, text, spans), the words of a slot and
    where they were cut from. Neighbouring slots are in order in a task."""
    rows = rows.withColumn("run", F.floor(F.col("slot") / RUN_SLOTS).cast("int")).repartition("shard", "run")
    part = F.struct("begin", "doc_id", "same", "copy", "from_word", "words", "text")
    rows = rows.groupBy("shard", "run", "slot").agg(F.first("source").alias("source"), F.first("block").alias("block"),
                                                    F.sort_array(F.collect_list(part)).alias("parts"))
    span = lambda x: F.struct(*[x[c].alias(c) for c in ("doc_id", "same", "copy", "from_word", "words")])
    return (rows.sortWithinPartitions("shard", "slot")
            .select("shard", "slot", "source", "block", F.array_join(F.transform("parts", lambda x: x["text"]), " ").alias("text"),
                    F.transform("parts", span).alias("spans")))


def written(rows: DataFrame, path: str, level: int, mode: str = "error") -> DataFrame:
    """``rows`` as written to ``path`` (with what is there, if ``mode`` is append)."""
    schema = rows.schema
    rows.write.mode(mode).option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)


def mixed(docs: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes the mix, the ``blocks`` of all shards, as Parquet to ``path`` (or the scratch folder).
    Returns it, and every row of ``sized`` with source_size, target and taken."""
    spark = docs.sparkSession
    rows = stored(sized(docs))
    s = stored(sources(rows))
    packs = stored(packed(rows))
    path = path or scratch_path(spark, f"mix-{uuid.uuid4().hex}")
    words = written(cut_words(docs, cuts(packs, s)), scratch_path(spark, f"cuts-{uuid.uuid4().hex}"), CUT_LEVEL)
    for k in range(PASSES):
        release(spark)
        out = written(blocks(words.where(F.col("shard") % PASSES == k)), path, MIX_LEVEL, "append" if k else "error")
    release(spark)
    took = (out.select(F.explode("spans").alias("x"))
            .groupBy(F.col("x.doc_id").alias("t_id"), F.col("x.same").alias("t_same"), F.col("x.copy").alias("t_copy")).agg(F.sum("x.words").alias("taken")))
    found = copied(packs)
    on = found["doc_id"].eqNullSafe(took["t_id"]) & (found["same"] == took["t_same"]) & (found["copy"] == took["t_copy"])
    found = found.join(took.hint("merge"), on, "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    facts = sent(s.select(F.col("source").alias("s_source"), "source_size", "target"), s.count(), SOURCES_TO_SEND)
    found = found.join(facts, found["source"].eqNullSafe(facts["s_source"]))
    return out, found.select("doc_id", "source", "size", "source_size", "target", "taken", *id_key(), "same")


def query(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document, from the mix as it was written."""
    return mixed(docs)[1].select("doc_id", "size", "source_size", "target", "taken")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the mix (to the folder of the setting MIX_PATH, if there is one). Returns the documents with
    size, source_size, target and taken (how many of their words the mix takes, repeats counted).
    Rows that are alike in id, source and text share their numbers out among themselves."""
    _, rows = mixed(docs, spark.conf.get(MIX_PATH, None))
    keys = [fresh(docs, f"__{k}") for k in TEXT_KEY]
    found = (rows.groupBy(*TEXT_KEY)
             .agg(F.first("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
                  F.sort_array(F.collect_list("taken")).alias("takens")))
    at = fresh(docs, "__at")
    own = docs.select("*", *[v.alias(k) for k, v in zip(keys, text_key())])
    own = own.withColumn(at, F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))))
    on = [own[k] == found[c] for k, c in zip(keys, TEXT_KEY)]
    joined = own.join(found, on)
    new = {"size": found["size"], "source_size": found["source_size"], "target": found["target"],
           "taken": F.element_at(found["takens"], own[at])}
    old = [own["`" + c.replace("`", "``") + "`"] for c in docs.columns if c.lower() not in new]
    return joined.select(*old, *[v.alias(k) for k, v in new.items()])


def _sql_stirred(y: str) -> str:
    for mask, factor in zip(MASKS, FACTORS):
        y = f"((xor(CAST({y} AS BIGINT), CAST({mask} AS BIGINT)) * {factor}) % {PRIME})"
    return y


def _sql_scatter(*keys: str) -> str:
    y = str(SEED % PRIME)
    for k in keys:
        y = _sql_stirred(f"({y} + (CAST({k} AS BIGINT) % {PRIME}) * {FACTORS[0]}) % {PRIME}")
    return y


def _oracle() -> str:
    """The same mix in SQL. The shuffle's rounds are one nested query each; a query computes the
    mirror image, the next one the swap."""
    inner = f"SELECT source, rank, n_blocks, k % n_blocks AS x, k // n_blocks AS times FROM s3 WHERE k < n_blocks * {MOST_TIMES}"
    for r in range(1, ROUNDS + 1):
        key = _sql_scatter("2", "rank", "times", str(r))
        inner = f"SELECT *, ((key % n_blocks - x) % n_blocks + n_blocks) % n_blocks AS y FROM (SELECT *, {key} AS key FROM ({inner}))"
        bit = _sql_stirred(f"(greatest(x, y) + key) % {PRIME}")
        inner = f"SELECT source, rank, n_blocks, times, CASE WHEN (({bit}) >> 10) & 1 = 1 THEN y ELSE x END AS x FROM ({inner})"
    u = _sql_scatter("1", "shard")
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, (rank - 1) % {WEIGHTS} + 1 AS weight FROM (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM s0)),
f1 AS (SELECT *, sum(source_size) OVER () AS all_words,
         sum(source_size) OVER () - sum(source_size * {MOST_TIMES}) OVER w + source_size * {MOST_TIMES} AS left_,
         sum(weight) OVER () - sum(weight) OVER w + weight AS weights
       FROM s1 WINDOW w AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f2 AS (SELECT *, source_size * {MOST_TIMES} * weights <= left_ * weight AS full_ FROM f1),
f3 AS (SELECT *, CASE WHEN full_ THEN CAST(source_size * {MOST_TIMES} AS DOUBLE) ELSE
         CAST((sum(source_size) OVER () - coalesce(sum(source_size * {MOST_TIMES}) FILTER (full_) OVER (), 0)) * weight AS DOUBLE)
         / CAST(sum(weight) FILTER (NOT full_) OVER () AS DOUBLE) END AS target,
         (source_size + {BLOCK - 1}) // {BLOCK} AS n_blocks FROM f2),
f4 AS (SELECT *, CASE WHEN source_size > 0 THEN target * n_blocks / source_size ELSE 0 END AS wanted FROM f3),
f5 AS (SELECT *, sum(wanted) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS to_ FROM f4),
f6 AS (SELECT *, coalesce(lag(to_) OVER (ORDER BY rank), 0) AS from_, max(to_) OVER () AS all_ FROM f5),
s2 AS (SELECT source, rank, source_size, target, n_blocks, CAST(floor(all_ + 0.5) AS BIGINT) AS n_slots,
         from_ / all_ AS share_from, to_ / all_ AS share_to FROM f6),
sh AS (SELECT *, unnest(range(0, (n_slots + {SHARD_SLOTS - 1}) // {SHARD_SLOTS})) AS shard FROM s2 WHERE n_slots > 0 AND n_blocks > 0),
dr AS (SELECT *, CAST(floor(CAST(n AS DOUBLE) * share_to + u) - floor(CAST(n AS DOUBLE) * share_from + u) AS BIGINT) AS n_drawn
       FROM (SELECT *, least({SHARD_SLOTS}, n_slots - shard * {SHARD_SLOTS}) AS n, CAST({u} AS DOUBLE) / {float(PRIME)} AS u FROM sh)),
s3 AS (SELECT source, rank, n_blocks, unnest(range(first_, first_ + n_drawn)) AS k FROM (
       SELECT *, CAST(coalesce(sum(n_drawn) OVER (PARTITION BY rank ORDER BY shard % {PREFIX_PIECES}, shard
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_ FROM dr) WHERE n_drawn > 0),
us AS (SELECT source, x AS block, count(*) AS times FROM ({inner}) GROUP BY source, x),
pk AS (SELECT *, row_number() OVER () AS r, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY
         coalesce((doc_id % {PREFIX_PIECES} + {PREFIX_PIECES}) % {PREFIX_PIECES}, 0), doc_id NULLS FIRST, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM d),
bl AS (SELECT *, unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) AS block FROM pk WHERE size > 0),
tk AS (SELECT r, sum((least(start + size, bl.block * {BLOCK} + {BLOCK}) - greatest(start, bl.block * {BLOCK})) * times) AS taken
       FROM bl JOIN us ON bl.source IS NOT DISTINCT FROM us.source AND bl.block = us.block GROUP BY r)
SELECT pk.doc_id, pk.size, s2.source_size, s2.target, CAST(coalesce(tk.taken, 0) AS BIGINT) AS taken
FROM pk JOIN s2 ON pk.source IS NOT DISTINCT FROM s2.source LEFT JOIN tk USING (r)
"""


ORACLE_SQL = _oracle()
