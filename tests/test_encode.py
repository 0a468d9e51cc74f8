import random

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.text import fold
from shelfwise.operators.encode import cut_word, encode, fits_sending, frequent_values, unknown_share
from shelfwise.operators.pretrained import encode_pretrained
from shelfwise.operators.vocabulary import (
    SPECIAL,
    piece_counts,
    piece_vocabulary,
    ranked,
    read_vocabulary,
    token_counts,
    word_vocabulary,
    write_vocabulary,
)
from shelfwise.plans.preprocess import preprocess
from shelfwise.sources.tables import read_table

TEXTS = [
    "The cat, the CAT and the dog.",
    "",
    None,
    "Caf\u00e9 au lait \u2014 na\u00efve co\u00f6peration!",
    "word " * 600,
    "x" * 120 + " unbelievable unaffable",
    "\u4e2d\u6587 mixed \u4e2d\u6587text a\u200bb",
    "\u00b4 \u0301 ... $5.00",
]


@pytest.fixture(scope="module")
def df(spark):
    rows = [(str(i), t, "L") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "asin string, combined_text string, main_cat string").repartition(3)


def arrays(found):
    return {r["asin"]: (r["input_ids"], r["attention_mask"]) for r in found.collect()}


def test_word_vocabulary_order(df):
    rows = word_vocabulary(df, min_count=2).orderBy("id").collect()
    assert [r["token"] for r in rows[:4]] == list(SPECIAL) and [r["id"] for r in rows] == list(range(len(rows)))
    assert [r["token"] for r in rows[4:6]] == ["word", "the"]


def test_ranking_by_range_equals_ranking_of_the_top(df):
    counts = token_counts(df)
    whole = {r["token"]: r["id"] for r in ranked(counts).collect()}
    top = {r["token"]: r["id"] for r in ranked(counts, 9).collect()}
    assert len(top) == 5 and top == {t: i for t, i in whole.items() if i < 9}


def test_piece_counts_by_hand(spark):
    df = spark.createDataFrame([("abc ab abc",)], "combined_text string")
    got = {r["token"]: r["n"] for r in piece_counts(df, longest=2).collect()}
    other = {"##a": 0, "b": 0, "c": 0}
    assert got == {"a": 3, "ab": 3, "##b": 3, "##bc": 2, "##c": 2, "abc": 2, **other}


def test_no_word_of_the_counted_texts_is_unknown(spark, df):
    rows = df.filter("asin <> '5'")  # a word beyond the scheme's longest stays unknown
    for size in (5, 60, None):
        vocabulary = piece_vocabulary(rows, max_size=size)
        for route in ("lookup", "join"):
            found = unknown_share(encode(rows, vocabulary, route=route)).first()
            assert found["unknown"] == 0 and found["ids"] > 0 and found["share"] == 0
    held = {r["token"] for r in piece_vocabulary(rows, max_size=5).collect()}
    assert {"t", "##t", "\u4e2d", "##\u4e2d", "##,"} <= held
    assert unknown_share(encode(df.filter("asin = '5'"), piece_vocabulary(df))).first()["unknown"] == 1
    assert unknown_share(encode(df.limit(0), piece_vocabulary(df))).first()["ids"] == 0


def test_bad_vocabularies_are_refused(spark, df, monkeypatch):
    special = [(t, i) for i, t in enumerate(SPECIAL)]
    for more in ([("a", 4), ("a", 5)], [("a", 4), ("b", 4)], [("a", None)]):
        for route in ("lookup", "join"):
            with pytest.raises(ValueError, match="vocabulary of"):
                encode(df, spark.createDataFrame(special + more, "token string, id long"), route=route)
    monkeypatch.setattr("shelfwise.operators.encode.MOST_SENT_ROWS", 1)
    with pytest.raises(ValueError, match="too large"):
        encode(df, word_vocabulary(df), level="word", route="lookup")


def test_pretrained_tokenizer(spark, df):
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    path = public.path("word_bpe_49k.json")
    whole = tokenizers.Tokenizer.from_file(path)
    wide = df.selectExpr("*", "1 AS input_ids", "'x' AS `odd name`")
    for length in (2, 9, 512):
        got = encode_pretrained(wide, path, 49406, 49407, 0, length)
        assert got.columns == ["asin", "main_cat", "odd name", "input_ids", "attention_mask"]
        for r in got.collect():
            ids = [49406, *whole.encode(TEXTS[int(r["asin"])] or "", add_special_tokens=False).ids[: length - 2], 49407]
            assert r["input_ids"] == ids + [0] * (length - len(ids))
            assert r["attention_mask"] == [1] * len(ids) + [0] * (length - len(ids))
    assert encode_pretrained(df.limit(0), path, 1, 2, 0).count() == 0
    with pytest.raises(ValueError):
        encode_pretrained(df, path, 1, 2, 0, 1)


def test_pretrained_tokenizer_ends_with_the_last_id(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    from shelfwise.operators import pretrained

    path = public.path("word_bpe_49k.json")
    whole = tokenizers.Tokenizer.from_file(path)
    draw = random.Random(5)
    marks = [" ", "  ", "\n", " \t ", "\u00a0 ", "\u0301", " \u0301", "'s ", "'", "<|endoftext|> ", "\u03a3 ", "E\u0301 ", "12 ", "\U0001f600", "\u4e2d\u6587 "]
    texts = ["".join(draw.choice("abcdefgh") * draw.randint(0, 9) + draw.choice(marks) for _ in range(n)) for n in (3, 90, 700, 5000)]
    texts += ["x" * 9000, " " * 9000 + "a", "word " * 9000, "", None, "a" + " " * 5000 + "b c"]
    taken = []
    groups = pretrained._groups
    monkeypatch.setattr(pretrained, "_groups", lambda spans, most: taken.extend(map(len, spans)) or groups(spans, most))
    for length in (2, 3, 17, 512):
        ids, mask = pretrained.framed_ids(texts, path, 49406, 49407, 0, length)
        for text, row, there in zip(texts, ids.tolist(), mask.tolist()):
            want = [49406, *whole.encode(text or "", add_special_tokens=False).ids[: length - 2], 49407]
            assert row == want + [0] * (length - len(want)) and there == [1] * len(want) + [0] * (length - len(want))
    taken.clear()
    pretrained.framed_ids(["word " * 9000], path, 49406, 49407, 0, 512)
    assert sum(taken) < 5000


def test_vocabulary_files(spark, df, tmp_path):
    path = tmp_path / "vocab.txt"
    path.write_text("[PAD]\n[UNK]\n[CLS]\n[SEP]\nthe\n##s\n", encoding="utf-8")
    rows = read_vocabulary(spark, str(path)).orderBy("id").collect()
    assert [(r["token"], r["id"]) for r in rows][-2:] == [("the", 4), ("##s", 5)] and len(rows) == 6
    vocabulary = piece_vocabulary(df, max_size=100)
    write_vocabulary(vocabulary, str(tmp_path / "table"))
    assert read_table(spark, str(tmp_path / "table")).count() == 100


@pytest.mark.parametrize("level", ["word", "piece"])
@pytest.mark.parametrize("length", [8, 512])
def test_routes_agree_and_lengths_are_fixed(df, level, length):
    vocabulary = word_vocabulary(df) if level == "word" else piece_vocabulary(df, max_size=120)
    first = arrays(encode(df, vocabulary, length, level, route="lookup"))
    second = arrays(encode(df, vocabulary, length, level, route="join"))
    assert first == second and len(first) == len(TEXTS)
    for ids, mask in first.values():
        used = sum(mask)
        assert len(ids) == len(mask) == length and mask == [1] * used + [0] * (length - used)
        assert ids[0] == 2 and ids[used - 1] == 3 and set(ids[used:]) <= {0}
    assert sum(first["1"][1]) == sum(first["2"][1]) == 2
    assert sum(first["4"][1]) == length


def test_word_level_unknown(spark, df):
    vocabulary = word_vocabulary(df, min_count=3)
    ids = arrays(encode(df, vocabulary, 10, "word"))["0"][0]
    known = {r["token"]: r["id"] for r in vocabulary.collect()}
    assert ids[1:8] == [known.get(t, 1) for t in ["the", "cat", "the", "cat", "and", "the", "dog"]]


def test_vocabulary_without_special_tokens_fails(spark, df):
    with pytest.raises(ValueError, match="lacks"):
        encode(df, spark.createDataFrame([("the", 0)], "token string, id long"))
    with pytest.raises(ValueError, match="level"):
        encode(df, word_vocabulary(df), level="letter")


def test_size_check(spark, monkeypatch):
    vocabulary = spark.createDataFrame([("ab", 0), ("cd", 1)], "token string, id long")
    assert fits_sending(vocabulary)
    monkeypatch.setattr("shelfwise.operators.encode.MOST_SENT_ROWS", 1)
    assert not fits_sending(vocabulary)


def test_cutting_by_hand():
    ids = {"un": 5, "##aff": 6, "##able": 7, "a": 8}
    assert cut_word("unaffable", ids, 1) == [5, 6, 7]
    assert cut_word("unb", ids, 1) == [1] and cut_word("a" * 101, ids, 1) == [1] and cut_word("", ids, 1) == []
    assert fold("\u00d1and\u00fa") == "nandu"


def test_pieces_equal_the_tokenizers_library(spark, folder):
    """Same ids as an independent word-piece implementation on every document."""
    tokenizers = pytest.importorskip("tokenizers")
    rows = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("asin"), F.col("text").alias("combined_text")
    )
    odd = spark.createDataFrame([(f"odd{i}", t or "") for i, t in enumerate(TEXTS)], "asin string, combined_text string")
    rows = rows.unionByName(odd)
    vocabulary = piece_vocabulary(rows, max_size=3_000)
    known = {r["token"]: r["id"] for r in vocabulary.collect()}
    model = tokenizers.BertWordPieceTokenizer(vocab=known, lowercase=True)
    model.enable_truncation(512)
    model.enable_padding(length=512)
    texts = {r["asin"]: r["combined_text"] for r in rows.collect()}
    got = arrays(encode(rows, vocabulary))
    wrong = []
    for key, text in texts.items():
        expected = model.encode(text)
        if got[key] != (expected.ids, expected.attention_mask):
            wrong.append(key)
    assert wrong == []


def test_random_texts_agree_between_routes(spark):
    chance = random.Random(9)
    alphabet = "abcd\u00e9 \u0301\u4e2d. -'\t"
    rows = [(str(i), "".join(chance.choices(alphabet, k=chance.randrange(60)))) for i in range(200)]
    df = spark.createDataFrame(rows, "asin string, combined_text string")
    vocabulary = piece_vocabulary(df, max_size=40, longest=3)
    assert arrays(encode(df, vocabulary, 20)) == arrays(encode(df, vocabulary, 20, route="join"))


def test_join_route_keeps_rows_without_or_with_equal_keys(spark, df):
    rows = spark.createDataFrame([(None, "the cat"), (None, "dog"), ("k", "the"), ("k", "the")], "asin string, combined_text string")
    vocabulary = word_vocabulary(df)
    first, second = (
        sorted(r["input_ids"] for r in encode(rows, vocabulary, 6, "word", route=way).collect()) for way in ("lookup", "join")
    )
    assert first == second and len(first) == 4


def test_preprocess_with_vocabulary(spark, df):
    raw = spark.createDataFrame([("1", "the cat", "b", "L")], "asin string, title string, brand string, main_cat string")
    got = preprocess(raw, vocabulary=piece_vocabulary(df, max_size=60), max_length=16)
    assert set(got.columns) == {"asin", "main_cat", "input_ids", "attention_mask"}
    assert got.schema["input_ids"].dataType.simpleString() == "array<int>" and len(got.first()["input_ids"]) == 16


def test_frequent_words_are_found_and_sent(spark, plan_of):
    """One word in every row, and as many words as rows beside it."""
    rows = [(i, f"the w{i} the x{i % 9}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "i int, combined_text string").repartition(4)
    words = df.select(F.explode(F.split("combined_text", " ")).alias("word"))
    hashed = words.distinct().withColumn("hash", F.xxhash64("word")).join(frequent_values(words, "word"), "hash", "left_semi")
    found = {r["word"] for r in hashed.collect()}
    assert {"the", *(f"x{i}" for i in range(9))} <= found and len(found) <= 1_000
    # w7 is left out of the vocabulary
    known = [*SPECIAL, "the", *(f"x{i}" for i in range(9)), *(f"w{i}" for i in range(3_000) if i != 7)]
    vocabulary = spark.createDataFrame([(t, i) for i, t in enumerate(known)], "token string, id int")
    lookup, join = (encode(df, vocabulary, 8, "word", route=r) for r in ("lookup", "join"))
    assert sorted(map(tuple, join.collect())) == sorted(map(tuple, lookup.collect()))
    assert "BroadcastHashJoin" in plan_of(join)


@pytest.mark.parametrize("bits", [64, 1 << 28])
def test_words_are_cut_alike_by_any_sieve(spark, monkeypatch, bits):
    """A full sieve names wrong parts; such words look up all their parts, no others do."""
    from shelfwise.operators import encode as module

    monkeypatch.setattr(module, "_MOST_SIEVE_BITS", bits)
    asked, all_parts = [], module._cut_by_all_parts
    monkeypatch.setattr(module, "_cut_by_all_parts", lambda words, *rest: asked.append(words.count()) or all_parts(words, *rest))
    ids = {t: i for i, t in enumerate([*SPECIAL, "un", "##able", "##a", "##ble", "able", "a", "##bl", "\u00e9t"])}
    words = ["unable", "Able", "unbl", "a", "b", "\u00e9ta", "", "a" * 101, "unablex"]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    vocabulary = spark.createDataFrame(list(ids.items()), "token string, id bigint")
    got = {r["word"]: r["pieces"] for r in module.cut_words(table, vocabulary, 1).collect()}
    assert got == {w: cut_word(fold(w), ids, 1) for w in words}
    assert bool(asked) == (bits == 64)


def test_rows_shuffle_numbers_not_words(spark, df, plan_of):
    """A word that fills a block stands in it once, whatever its length; the rest are numbers."""
    from shelfwise.operators.encode import _blocks

    rows = spark.createDataFrame([(i, ["same"] * 50 + [f"w{i % 3}"]) for i in range(90)], "i int, __words array<string>").repartition(3)
    coded, listed = _blocks(rows)
    assert coded.count() == 90 and listed.count() <= 4 * coded.select("__c.block").distinct().count() <= 12
    assert "__words" not in coded.columns


def test_pieces_are_counted_on_distinct_words(df, plan_of):
    """Texts are split, and their words folded, before a written table; a plan with both folds every word of every text."""
    assert "regexp" not in plan_of(piece_counts(df))


def test_vocabulary_of_a_size_is_the_top_of_the_whole(df):
    whole = {r["token"]: r["id"] for r in piece_vocabulary(df, max_size=None).collect()}
    singles = sum(len(t.removeprefix("##")) == 1 for t in whole)
    for size in (1, singles + 30, 10_000):
        top = {r["token"]: r["id"] for r in piece_vocabulary(df, max_size=size).collect()}
        assert top == {t: i for t, i in whole.items() if i < size or len(t.removeprefix("##")) == 1 or t in SPECIAL}
