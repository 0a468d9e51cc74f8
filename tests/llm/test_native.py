import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from shelfwise.llm.exact_dedup import DigestIndex, digests, mark_duplicates, without_duplicates
from shelfwise.llm.license_scan import PHRASES, scan_licenses
from shelfwise.llm.line_dedup import LineRuns, drop_repeated_lines, key_counts
from shelfwise.llm.sharding import OVERHEAD, ShardTree, assign_shards
from shelfwise.scratch import scratch_path
from tests.llm.conftest import ODD, crc


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("extra", [False, True])
def test_exact_groups(rows, extra):
    got = mark_duplicates(rows(ODD, extra)).collect()
    groups = defaultdict(list)
    for i, t in ODD:
        groups[sha(t)].append(i)
    assert len(got) == len(ODD)
    for r in got:
        ids = [i for i in groups[r.digest] if i is not None]
        assert r.keep_id == (max(ids) if ids else None)
        assert r.group_size == len(groups[r.digest]) and r.kept == (r.doc_id == r.keep_id)


def test_exact_hot_group_and_later_batches(spark, rows):
    many = [(i, "hot" if i % 2 else f"text {i}") for i in range(4000)]
    got = {r.doc_id: r for r in mark_duplicates(rows(many)).collect()}
    assert got[1].keep_id == 3999 and got[1].group_size == 2000 and sum(r.kept for r in got.values()) == 2001
    path = scratch_path(spark, "index-test")
    DigestIndex(spark, path, 4).add(digests(rows(many[:10])))
    again = DigestIndex(spark, path, 4)
    fresh = again.add(digests(rows([*many[:12], (50, "new"), (51, "new")])))
    assert sorted((r.keep_id, r.group_size) for r in fresh.collect()) == [(10, 1), (51, 2)]
    assert again.rows().count() == 8
    sizes = {r.keep_id: r.group_size for r in again.rows().collect()}
    # ids 1, 3, 5, 7, 9 came first and 1 to 11 again
    assert sizes[9] == 11 and sizes[8] == 2 and sizes[51] == 2


def test_a_stored_index_keeps_its_buckets(spark, rows):
    path = scratch_path(spark, "index-width")
    texts = [(i, f"text {i}") for i in range(200)]
    DigestIndex(spark, path, 4).add(digests(rows(texts)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    again = DigestIndex(spark, path)
    assert again.buckets == 4 and again.add(digests(rows(texts))).count() == 0
    spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(ValueError):
        DigestIndex(spark, path, 8)


def test_batches_of_falling_ids_settle_the_keeper(spark, rows):
    pairs = [(i, f"text {i % 7}") for i in range(100)] + [(None, "text 3"), (None, "alone")]
    for batches in (1, 2, 5):
        index = DigestIndex(spark)
        index.add_falling(digests(rows(pairs)), batches)
        got = {(r.digest, r.keep_id, r.group_size) for r in index.rows().collect()}
        sizes = Counter(t for _, t in pairs)
        assert got == {(sha(t), max((i for i, x in pairs if x == t and i is not None), default=None), n) for t, n in sizes.items()}


def test_without_duplicates_keeps_columns(rows):
    df = rows(ODD, True)
    kept = without_duplicates(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect())[10] == 1 and kept.filter("doc_id in (4, 5)").count() == 0
    again = df.union(df).selectExpr("*", "1 AS _keep", "2 AS _digest", "3 AS document_key")
    once = without_duplicates(again)
    assert once.columns == again.columns and once.count() == kept.count() == len({sha(t) for _, t in ODD})
    assert mark_duplicates(rows([])).count() == 0 and without_duplicates(rows([])).count() == 0


def test_shards_hold_their_law(rows):
    tree = ShardTree.even(4, 2, 5)
    pairs = [(i, f"text {i % 50}") for i in range(6000)] + ODD
    got = assign_shards(rows(pairs, True), tree).collect()
    assert len(got) == len(pairs)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 40
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + OVERHEAD, crc(t)) for i, t in pairs
    )
    by_key = defaultdict(set)
    for r in got:
        by_key[r.doc_id].add(r.shard)
    assert all(len(s) == 1 for s in by_key.values())
    assert max(map(len, slots.values())) < 2 * min(map(len, slots.values()))


def test_weights_confine_movement(rows):
    docs = rows([(i, "t") for i in range(5000)])
    before = ShardTree((((1.0, 1.0), (1.0, 1.0)), ((2.0, 1.0),)))
    after = ShardTree((((1.0, 1.0), (1.0, 1.0)), ((2.0, 3.0),)))
    old, new = ({r.doc_id: r.shard for r in assign_shards(docs, t).collect()} for t in (before, after))
    moved = {(old[i], new[i]) for i in old if old[i] != new[i]}
    assert moved and all(b in (4, 5) for _, b in moved) and (5, 4) not in moved
    share = Counter(old.values())
    assert math.isclose(share[4] / 5000, 2 / 7, rel_tol=0.15)
    with pytest.raises(ValueError):
        ShardTree((((0.0,),),))
    assert assign_shards(rows([]), before).count() == 0


def line_brute(pairs, least_docs):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(table)
    count = Counter(k for _, t in pairs for k in {key(x) for x in (t or "").split("\n")} if k)
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if count[key(x)] < least_docs]
        yield i, len(lines), len(lines) - len(kept), "\n".join(kept)


@pytest.mark.parametrize("batches", [1, 5])
def test_lines(rows, batches):
    pairs = [(i, f"Shared A\n only {i}\n\t shared a \x0b\nÉ{i % 7}\n") for i in range(60)]
    pairs += ODD + [(100 + i, "Shared A") for i in range(3)]
    got = drop_repeated_lines(rows(pairs, True), 9, 1, batches).collect()
    assert Counter(map(tuple, got)) == Counter(line_brute(pairs, 9))
    assert drop_repeated_lines(rows([]), 2).count() == 0


def test_runs_are_compacted_and_reopened(spark, rows):
    path = scratch_path(spark, "runs-test")
    runs = LineRuns(spark, None, 4, fanout=2)
    pairs = [(i, f"a\nb{i % 3}\nc{i}") for i in range(12)]
    for at in range(0, 12, 3):
        runs.add(key_counts(rows(pairs[at : at + 3])))
    assert [n for n, _ in runs.levels] == [2]
    again = LineRuns(spark, runs.path, 4)
    assert again.levels == runs.levels and again.version == runs.version and path
    chosen = LineRuns(spark, path)
    chosen.add(key_counts(rows(pairs[:2])))
    # a driver lost between writing a run and committing it leaves a folder that nobody reads
    chosen._store(key_counts(rows(pairs[:2])).selectExpr("*", "true AS fresh"), 0)
    reopened = LineRuns(spark, path)
    reopened.add(key_counts(rows(pairs[2:3])))
    assert {(r.docs) for r in LineRuns(spark, path).totals().collect()} == {3, 1}
    totals = {r.docs for r in again.totals().collect()}
    assert totals == {12, 4, 1} and again.totals().count() == 16


def words_of(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(table))


def test_licenses(rows):
    pairs = ODD + [
        (20, "Released under the MIT License. " * 3),
        (21, "the Apache License, Version 2.0 and CC BY-NC 4.0; cc by nc"),
        (22, "mit license apache license version two cc by"),
        (23, "This work is licensed under the GNU General Public License, version 3."),
        (24, "permission is hereby granted, free of very charge, to any person obtaining a copy of this software "
             "and the associated documentation files (the Software) to deal in the software without any restriction"),
        (25, "Éunder the MIT license under the mit licensed"),
    ]
    got = scan_licenses(rows(pairs, True)).collect()
    assert len(got) == len(pairs)
    texts = {i: t for i, t in pairs if i is not None}
    for r in got:
        if r.doc_id is None:
            continue
        w = words_of(texts[r.doc_id])
        places = sorted(
            (i, n) for p, n in PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()
        )
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({n for _, n in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    found = {r.doc_id: r.labels for r in got}
    assert found[23] == "gpl-3" and found[24] == "mit" and found[22] == "" and found[3] == ""
    assert scan_licenses(rows([])).count() == 0
