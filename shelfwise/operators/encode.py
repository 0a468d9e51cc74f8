"""Text to fixed-length id and mask arrays.

Two routes with equal results. While the vocabulary is small enough, a checked fact, it is sent to
the executors once and every row is encoded where it lies: no shuffle. A larger vocabulary is
joined instead. Splitting, cutting, padding and masks are Spark expressions on both routes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.arrays import ratio
from shelfwise.functions.text import fold, folded, rough_words, tokens
from shelfwise.operators.vocabulary import CONTINUES, END, LONGEST_WORD, PAD, START, UNKNOWN
from shelfwise.schema import TEXT
from shelfwise.scratch import written

# Every Python worker holds the vocabulary: some 50 MB at these bounds.
MOST_SENT_ROWS = 300_000
MOST_SENT_CHARS = 6_000_000
_MEMO_WORDS = 200_000
# Words that the join route sends to the rows instead of shuffling them, and values its sketch keeps.
_FREQUENT, _TRACKED = 1_000, 10_000
# The join route's sieve of a vocabulary: 32 MB at most.
_MOST_SIEVE_BITS = 1 << 28
# Stands for the id of a part that the sieve let through and the vocabulary does not hold.
_ABSENT = -(1 << 31)
# Rows of a block whose ids are put together at a time.
_ROWS_AT_ONCE = 1_000


def fits_sending(vocabulary: DataFrame) -> bool:
    """Whether a vocabulary is small enough to be held by every executor."""
    size = vocabulary.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("token")).alias("chars")).first()
    return size["n"] <= MOST_SENT_ROWS and (size["chars"] or 0) <= MOST_SENT_CHARS


def check_vocabulary(vocabulary: DataFrame) -> None:
    """Refuse a vocabulary that names a token or an id twice, or has a null among them."""
    found = vocabulary.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("token").alias("tokens"), F.count_distinct("id").alias("ids")
    ).first()
    if not found["rows"] == found["tokens"] == found["ids"]:
        raise ValueError(f"vocabulary of {found['rows']} rows has {found['tokens']} tokens and {found['ids']} ids")


def special_ids(pairs: Iterable[tuple[str, int]]) -> dict[str, int]:
    wanted = (PAD, UNKNOWN, START, END)
    found = {token: i for token, i in pairs if token in wanted}
    missing = [t for t in wanted if t not in found]
    if missing:
        raise ValueError(f"vocabulary lacks {missing}")
    return found


def framed(pieces: Column, special: dict[str, int], max_length: int) -> tuple[Column, Column]:
    """Ids and mask of exactly ``max_length``: start, pieces cut to fit, end, padding."""
    cut = F.slice(F.coalesce(pieces, F.array().cast("array<int>")), 1, max_length - 2)
    one = lambda t: F.array(F.lit(special[t]).cast("int"))
    used = F.size(cut) + 2
    pad = F.array_repeat(F.lit(special[PAD]).cast("int"), max_length - used)
    mask = F.concat(
        F.array_repeat(F.lit(1), used),
        F.array_repeat(F.lit(0), max_length - used),
    )
    return F.concat(one(START), cut, one(END), pad), mask


def cut_word(word: str, ids: dict[str, int], unknown: int) -> list[int]:
    """Ids of the longest known pieces from left to right; one unknown id if some part is not known."""
    if len(word) > LONGEST_WORD:
        return [unknown]
    found, at = [], 0
    while at < len(word):
        mark = CONTINUES if at else ""
        for end in range(len(word), at, -1):
            piece = ids.get(mark + word[at:end])
            if piece is not None:
                found.append(piece)
                at = end
                break
        else:
            return [unknown]
    return found


def _word_lookup(sent: Broadcast, unknown: int) -> Callable:
    @F.arrow_udf("array<int>")
    def look_up(words: pa.Array) -> pa.Array:
        known, ids = sent.value
        at = pc.index_in(words.flatten(), value_set=known)
        found = pc.fill_null(pc.take(ids, at), unknown)
        return pa.ListArray.from_arrays(_offsets(words), found)

    return look_up


def _piece_lookup(sent: Broadcast, unknown: int) -> Callable:
    tables: dict[str, dict] = {}

    @F.arrow_udf("array<int>")
    def look_up(words: pa.Array) -> pa.Array:
        if not tables:
            known, ids = sent.value
            tables["ids"] = dict(zip(known.to_pylist(), ids.to_pylist()))
            tables["memo"] = {}
        ids, memo = tables["ids"], tables["memo"]
        # Python sees each distinct word of the batch once; rows are put together by numpy.
        coded = words.flatten().dictionary_encode()
        if len(memo) > _MEMO_WORDS:
            memo.clear()
        cut = []
        for word in coded.dictionary.to_pylist():
            pieces = memo.get(word)
            if pieces is None:
                pieces = memo[word] = cut_word(fold(word), ids, unknown)
            cut.append(pieces)
        sizes = np.fromiter((len(p) for p in cut), np.int64, len(cut))
        starts = np.cumsum(sizes) - sizes
        flat = np.fromiter((i for p in cut for i in p), np.int32, int(sizes.sum()))
        codes = coded.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[codes] if len(codes) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        within = np.arange(ends[-1]) - np.repeat(ends[:-1], lengths)
        taken = flat[np.repeat(starts[codes], lengths) + within] if len(codes) else flat
        bounds = ends[np.asarray(_offsets(words))].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(taken, pa.int32()))

    return look_up


def unknown_share(encoded: DataFrame, unknown: int = 1) -> DataFrame:
    """One row: ``ids`` without special ones and padding, the ``unknown`` among them, their ``share``."""
    used = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, m: a + m) - 2
    missed = F.size(F.filter("input_ids", lambda i: i == unknown)).cast("bigint")
    totals = encoded.agg(
        F.coalesce(F.sum(used), F.lit(0)).alias("ids"), F.coalesce(F.sum(missed), F.lit(0)).alias("unknown")
    )
    return totals.withColumn("share", ratio(F.col("unknown"), F.col("ids")))


def _offsets(lists: pa.Array) -> pa.Array:
    """List boundaries from 0; a null list counts as empty."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def _by_lookup(
    df: DataFrame, words: Column, vocabulary: DataFrame, level: str
) -> tuple[DataFrame, dict[str, int]]:
    known = vocabulary.select("token", F.col("id").cast("int")).toArrow().combine_chunks()
    tokens_of, ids_of = (known.column(c).combine_chunks() for c in ("token", "id"))
    is_special = pc.is_in(tokens_of, value_set=pa.array([PAD, UNKNOWN, START, END]))
    special = special_ids(zip(tokens_of.filter(is_special).to_pylist(), ids_of.filter(is_special).to_pylist()))
    sent = df.sparkSession.sparkContext.broadcast((tokens_of, ids_of))
    make = _word_lookup if level == "word" else _piece_lookup
    return df.withColumn("__pieces", make(sent, special[UNKNOWN])(words)), special


def frequent_values(rows: DataFrame, on: str) -> DataFrame:
    """Hashes of the most frequent values of a column, at most ``_FREQUENT``, from a sketch made on the map side.

    Every value that fills more than one in ``_FREQUENT`` rows is among them. One column, ``hash``.
    """
    hashed = rows.select(F.xxhash64(on).alias("hash"))
    top = hashed.agg(F.expr(f"approx_top_k(hash, {_FREQUENT}, {_TRACKED})").alias("top"))
    return top.select(F.explode("top").alias("top")).select(F.col("top")["item"].alias("hash"))


def _skewed_join(rows: DataFrame, small: DataFrame, on: str, how: str) -> DataFrame:
    """Join (inner or left) on a column with very frequent values, each once in ``small``.

    What ``small`` has of the frequent values, a bounded number, is sent to the rows; only rows with other
    values are shuffled. ``rows`` is read three times, so give a written table.
    """
    frequent = F.broadcast(written(frequent_values(rows, on), "frequent"))
    among = F.xxhash64(on) == F.col("hash")
    sent = F.broadcast(small.join(frequent, among, "left_semi"))
    rest = rows.join(frequent, among, "left_anti")
    return rows.join(frequent, among, "left_semi").join(sent, on, how).unionByName(rest.join(small, on, how))


def _cut_by_all_parts(words: DataFrame, vocabulary: DataFrame, unknown: int) -> DataFrame:
    """``(word, pieces)`` for a table of distinct folded words, by joining all their parts to the vocabulary.

    A word has at most 100 characters here, hence a bounded number of parts. The longest known part
    per start is kept, then the starts are walked from left to right.
    """
    base = words.withColumn("__folded", F.col("word"))
    usable = base.filter(F.length("__folded").between(1, LONGEST_WORD))
    size = F.length("__folded")
    spots = (
        usable.select("word", "__folded", F.explode(F.sequence(F.lit(1), size)).alias("at"))
        .select("word", "__folded", "at", F.explode(F.sequence(F.lit(1), size - F.col("at") + 1)).alias("length"))
        .withColumn(
            "token",
            F.concat(
                F.when(F.col("at") > 1, F.lit(CONTINUES)).otherwise(F.lit("")),
                F.substr("__folded", F.col("at"), F.col("length")),
            ),
        )
    )
    known = vocabulary.select("token", F.col("id").cast("int"))
    parts = (
        _skewed_join(written(spots.drop("__folded"), "parts"), known, "token", "inner")
        .groupBy("word", "at")
        .agg(F.max(F.struct("length", "id")).alias("best"))
        .groupBy("word")
        .agg(F.map_from_entries(F.collect_list(F.struct("at", "best"))).alias("best"))
    )
    # Walk: stand at 1, take the best part, step over it. A missing part leaves the walk stuck.
    empty = F.array().cast("array<int>")
    start = F.struct(F.lit(1).alias("at"), empty.alias("ids"))

    def step(state: Column, here: Column) -> Column:
        best = F.try_element_at("best", here)
        moved = F.struct(
            (state["at"] + best["length"]).alias("at"), F.concat(state["ids"], F.array(best["id"])).alias("ids")
        )
        return F.when((state["at"] == here) & best.isNotNull(), moved).otherwise(state)

    walked = F.aggregate(F.sequence(F.lit(1), size), start, step)
    unknown_word = F.array(F.lit(unknown).cast("int"))
    return (
        base.join(parts, "word", "left")
        .withColumn("__walk", F.when(size.between(1, LONGEST_WORD) & F.col("best").isNotNull(), walked))
        .select(
            "word",
            F.when(size == 0, empty)
            .when(F.col("__walk")["at"] == size + 1, F.col("__walk")["ids"])
            .otherwise(unknown_word)
            .alias("pieces"),
        )
    )


def _spots(raw: bytes, bits: int) -> Iterator[int]:
    """The two bits of a token in a sieve, the cheaper one first."""
    yield crc32(raw) % bits
    yield int.from_bytes(blake2b(raw, digest_size=8).digest(), "little") % bits


def _sieve(vocabulary: DataFrame) -> tuple[bytes, int]:
    """A bit map that holds every token of a vocabulary and few others, and the length of the longest token.

    It has 64 bits a token, at most ``_MOST_SIEVE_BITS`` whatever the vocabulary. Tasks set the bits.
    """
    size = vocabulary.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("token")).alias("longest")).first()
    bits = min(_MOST_SIEVE_BITS, max(64, 1 << (64 * size["n"]).bit_length()))

    @F.arrow_udf("array<bigint>")
    def spots(tokens: pa.Array) -> pa.Array:
        return pa.array([list(_spots(t.encode(), bits)) for t in tokens.to_pylist()], pa.list_(pa.int64()))

    at = vocabulary.select(F.explode(spots("token")).alias("at"))
    set_bits = at.groupBy(F.shiftright("at", 6).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("set")
    )
    found = set_bits.toArrow()
    held = np.zeros(bits // 64, "<i8")
    held[found.column("slot").to_numpy()] = found.column("set").to_numpy()
    return held.tobytes(), size["longest"] or 0


def _chain(sent: Broadcast) -> Callable:
    """The longest parts, from left to right, that a sieve lets through, and whether they make up the whole word."""

    @F.arrow_udf("struct<whole: boolean, tokens: array<string>>")
    def chain(words: pa.Array) -> pa.Array:
        held, longest = sent.value
        bits = 8 * len(held)

        def known(token: str) -> bool:
            raw = token.encode()
            return all(held[at >> 3] >> (at & 7) & 1 for at in _spots(raw, bits))

        whole, cut = [], []
        for word in words.to_pylist():
            found, at, stuck = [], 0, len(word) > LONGEST_WORD
            while at < len(word) and not stuck:
                mark = CONTINUES if at else ""
                for end in range(min(len(word), at + longest), at, -1):
                    if known(mark + word[at:end]):
                        found.append(mark + word[at:end])
                        at = end
                        break
                else:
                    stuck = True
            whole.append(not stuck)
            cut.append(found)
        return pa.StructArray.from_arrays([pa.array(whole, pa.bool_()), pa.array(cut, pa.list_(pa.string()))], ["whole", "tokens"])

    return chain


def cut_words(words: DataFrame, vocabulary: DataFrame, unknown: int) -> DataFrame:
    """``(word, pieces)`` for a table of distinct words, by joining the parts they are cut into to the vocabulary.

    A sieve of the vocabulary, bounded in size, names the longest part at each place; a join with the whole
    vocabulary tells its id, or that the sieve was wrong. Only words with such a part, few unless the
    vocabulary is far larger than the sieve, look up all their parts.
    """
    spelled = written(words.select("word", folded(F.col("word")).alias("folded")), "folded")
    sent = words.sparkSession.sparkContext.broadcast(_sieve(vocabulary))
    # A few bytes a word, but much work: spread the words by number.
    distinct = spelled.select("folded").distinct().repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chains = distinct.withColumn("chain", _chain(sent)("folded")).select("folded", "chain.whole", F.col("chain.tokens").alias("__words"))
    known = vocabulary.select(F.col("token").alias("word"), F.array(F.col("id").cast("int")).alias("pieces"))
    found = written(_placed(*_blocks(chains), known, _ABSENT, LONGEST_WORD), "chains")
    wrong = F.array_contains("__pieces", _ABSENT)
    cut = found.filter(~wrong).select(
        F.col("folded").alias("word"),
        F.when(F.col("whole"), F.col("__pieces")).otherwise(F.array(F.lit(unknown).cast("int"))).alias("pieces"),
    )
    suspects = found.filter(wrong).select(F.col("folded").alias("word"))
    if not suspects.isEmpty():
        cut = cut.unionByName(_cut_by_all_parts(suspects, vocabulary, unknown))
    return spelled.join(cut.withColumnRenamed("word", "folded"), "folded").select("word", "pieces")


def _coded() -> Callable:
    """Words of a batch, a block named by its first row, as numbers; the distinct ones stand with the first row."""

    @F.arrow_udf("struct<block: bigint, codes: array<int>, words: array<string>>")
    def code(rows: pa.Array, words: pa.Array) -> pa.Array:
        n, coded = len(words), words.flatten().dictionary_encode()
        block = pa.array(np.full(n, rows[0].as_py() if n else 0, np.int64))
        codes = pa.ListArray.from_arrays(_offsets(words), coded.indices.cast(pa.int32()))
        ends = np.full(n + 1, len(coded.dictionary) if n else 0, np.int32)
        ends[0] = 0
        listed = pa.ListArray.from_arrays(pa.array(ends), coded.dictionary, mask=pa.array(np.arange(n) > 0))
        return pa.StructArray.from_arrays([block, codes, listed], ["block", "codes", "words"])

    return code


def _blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows in blocks, a batch each, their ``__words`` as numbers, and ``(block, code, word)``: the distinct words of each block."""
    numbered = rows.withColumn("__row", F.monotonically_increasing_id())
    coded = written(numbered.withColumn("__c", _coded()("__row", "__words")).drop("__row", "__words"), "coded")
    listed = coded.filter(F.col("__c.words").isNotNull()).select(
        F.col("__c.block").alias("block"), F.posexplode("__c.words").alias("code", "word")
    )
    return coded, written(listed, "block-words")


def _placed(coded: DataFrame, listed: DataFrame, ids: DataFrame, missing: int, most: int) -> DataFrame:
    """Rows of ``_blocks`` with the ``__pieces`` of their words, at most ``most``, by joining to ``(word, pieces)``.

    Every distinct word of a block is joined once. Rows hold numbers for words, and are shuffled once, by
    block, to meet the pieces of the block's words.
    """
    kept = [c for c in coded.columns if c != "__c"]
    joined = _skewed_join(listed, ids, "word", "left").select(
        "block", "code", F.coalesce("pieces", F.array(F.lit(missing).cast("int"))).alias("pieces")
    )

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        pieces = right.column("pieces").combine_chunks()
        codes_of, flat = right.column("code").to_numpy(), pieces.flatten().to_numpy(zero_copy_only=False)
        lengths = pieces.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes, starts = (np.zeros(len(codes_of), np.int64) for _ in range(2))
        sizes[codes_of], starts[codes_of] = lengths, np.cumsum(lengths) - lengths
        made = []
        for low in range(0, left.num_rows, _ROWS_AT_ONCE):
            lists = left.column("codes").slice(low, _ROWS_AT_ONCE).combine_chunks()
            codes, ends = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(_offsets(lists))
            of_code = np.concatenate([[0], np.cumsum(sizes[codes])])
            within = np.arange(of_code[-1]) - np.repeat(of_code[:-1], sizes[codes])
            taken = flat[np.repeat(starts[codes], sizes[codes]) + within]
            bounds = of_code[ends]
            held = np.arange(of_code[-1]) - np.repeat(bounds[:-1], np.diff(bounds)) < most
            cut = np.concatenate([[0], np.cumsum(np.minimum(np.diff(bounds), most))]).astype(np.int32)
            made.append(pa.ListArray.from_arrays(pa.array(cut), pa.array(taken[held], pa.int32())))
        return pa.table({**{c: left.column(c) for c in kept}, "__pieces": pa.chunked_array(made, pa.list_(pa.int32()))})

    schema = T.StructType([*(coded.schema[c] for c in kept), T.StructField("__pieces", T.ArrayType(T.IntegerType()))])
    split = coded.select(*(F.col(f"`{c}`") for c in kept), F.col("__c.block").alias("block"), F.col("__c.codes").alias("codes"))
    return split.groupBy("block").cogroup(joined.groupBy("block")).applyInArrow(place, schema)


def _by_join(rows: DataFrame, vocabulary: DataFrame, level: str, special: dict[str, int], most: int) -> DataFrame:
    """Rows with their ``__words``, joined to the ids of their words."""
    coded, listed = _blocks(rows)
    if level == "word":
        ids = vocabulary.select(F.col("token").alias("word"), F.array(F.col("id").cast("int")).alias("pieces"))
    else:
        words = written(listed.select("word").distinct(), "words")
        ids = written(cut_words(words, vocabulary, special[UNKNOWN]), "cut")
    return _placed(coded, listed, ids, special[UNKNOWN], most)


def encode(
    df: DataFrame,
    vocabulary: DataFrame,
    max_length: int = 512,
    level: str = "piece",
    text: str = TEXT,
    route: str | None = None,
) -> DataFrame:
    """Replace the text by ``input_ids`` and ``attention_mask``, both ``max_length`` long.

    ``level`` is ``word`` (whole words) or ``piece`` (words cut into known pieces). Every word gives
    at least one id, so words beyond the length limit cannot matter and are not looked up.
    ``route`` overrides the choice between ``lookup`` and ``join``; the join first writes the rows once,
    with numbers for words. A vocabulary with a token or an id twice is refused on both routes, one that
    is too large to send on the lookup route.
    """
    if level not in ("word", "piece"):
        raise ValueError(f"unknown level {level}")
    check_vocabulary(vocabulary)
    fits = fits_sending(vocabulary)
    if route == "lookup" and not fits:
        raise ValueError("the vocabulary is too large to be sent: use the join route")
    route = route or ("lookup" if fits else "join")
    words = F.slice((tokens if level == "word" else rough_words)(F.col(text)), 1, max_length - 2)
    if route == "lookup":
        found, special = _by_lookup(df, words, vocabulary, level)
    else:
        named = vocabulary.filter(F.col("token").isin(PAD, UNKNOWN, START, END)).select("token", "id")
        special = special_ids(named.collect())
        found = _by_join(df.withColumn("__words", words).drop(text), vocabulary, level, special, max_length - 2)
    ids, mask = framed(F.col("__pieces"), special, max_length)
    return found.withColumn("input_ids", ids).withColumn("attention_mask", mask).drop("__pieces", text)
