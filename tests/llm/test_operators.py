"""Operators on small hand-made tables: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from haulmark.llm import (
    components, decontaminate, fingerprints, html_text, line_dedup, near_dup, sentencepiece_bpe, substring_dedup,
    token_counts, toxicity, warc,
)
from haulmark.llm.queries import piece_model

# Columns that operators use inside, as ordinary columns of the caller.
SCHEMA = "doc_id bigint, text string, id string, row int, key string, n_lines string, start int, rejected string"
RANDOM = random.Random(7)
VOCABULARY = ["".join(RANDOM.choice("abcdeé") for _ in range(RANDOM.randint(2, 6))) for _ in range(400)]


def words(n: int, seed: int) -> list[str]:
    source = random.Random(seed)
    return [source.choice(VOCABULARY) for _ in range(n)]


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(key, text, "x", 1, "k", "n", 2, "r") for key, text in rows], SCHEMA)


# --- lines ---------------------------------------------------------------------------------------------------------


def plain_lines(rows):
    held = {}
    for key, text in rows:
        for line in (text or "").split("\n"):
            if key is not None:
                k = line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
                held.setdefault(k, set()).add(key)
    out = []
    for key, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            k = line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
            if key is None or len(k) < 10 or len(held[k]) < 2 or min(held[k]) == key:
                kept.append(line)
        out.append((key, None if text is None else "\n".join(kept)))
    return sorted(out, key=repr)


LINES = [
    (1, "a line of text here\nunique one here\na line of text here"), (2, "  A LINE of text HERE \t\nsecond own line"),
    (2, "second own line\nanother text of two"), (3, None), (4, ""), (None, "a line of text here"), (5, "éééééééééé\nx"),
    (6, "éééééééééé\nÉÉÉÉÉÉÉÉÉÉ"), (7, "\n\n\n"), (8, "short\nshort"), (9, "short"), (2, "second own line\nanother text of two"),
]


def test_lines(spark):
    result = line_dedup.drop_repeated_lines(frame(spark, LINES))
    assert sorted(((r.doc_id, r.text) for r in result.collect()), key=repr) == plain_lines(LINES)
    assert set(SCHEMA.replace(",", "").split()[::2]) <= set(result.columns)


def test_hot_line_spans_many_ranges(spark):
    rows = [(i, f"the same line everywhere\nown line number {i}") for i in range(3000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        bitmaps = line_dedup.line_keep_bitmaps(frame(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.id for r in bitmaps if r.n_dropped == 0} == {0}
    assert all(np.unpackbits(np.frombuffer(zlib.decompress(r.keep_bitmap), np.uint8), count=2).tolist() == [r.id == 0, 1]
               for r in bitmaps)


# --- passages ------------------------------------------------------------------------------------------------------


def plain_passages(rows, window):
    first = {}
    split = [(key, (text or "").encode().split()) for key, text in rows]
    for key, w in split:
        for i in range(len(w) - window + 1):
            if key is not None:
                k = tuple(w[i:i + window])
                first[k] = min(first.get(k, key), key)
    out = []
    for key, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if key is not None and first[tuple(w[i:i + window])] < key:
                gone[i:i + window] = [True] * window
        out.append((key, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def passages():
    hot, rows = words(70, 1), [(None, " ".join(words(70, 1))), (90, None), (91, ""), (92, " \n ")]
    for i in range(60):
        own = words(RANDOM.randint(0, 90), 100 + i)
        if i % 3 == 0:
            own[len(own) // 2:len(own) // 2] = hot[RANDOM.randint(0, 20):]
        if i % 5 == 0:
            own += words(60, i % 4 + 50)
        rows.append((i, "\n".join(own)))
    rows += [(200, " ".join(["same"] * 300)), (201, " ".join(["same"] * 120)), (7, rows[11][1]), (7, rows[11][1])]
    edited = words(400, 33)
    for i in range(8):
        copy = list(edited)
        copy[RANDOM.randrange(400)] = f"edit{i}"
        rows.append((300 + i, " ".join(copy)))
    rows.append((400, " ".join(words(30_000, 77))))
    rows.append((399, " ".join(words(30_000, 77)[10_000:10_200])))
    return rows


@pytest.mark.parametrize("window,anchor", [(50, 10), (12, 4)])
def test_passages(spark, window, anchor):
    rows = passages()
    result = substring_dedup.remove_repeated_passages(frame(spark, rows), window=window, anchor=anchor)
    assert sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in result.collect()), key=repr) == plain_passages(rows, window)


# --- tokens --------------------------------------------------------------------------------------------------------

TEXTS = st.text(alphabet=st.sampled_from("ab  \n\t▁éTheing世\U0001F600\x00.,!=-1"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_encoding_is_the_librarys(text):
    library, own = LIBRARY, sentencepiece_bpe.load(piece_model())
    ids = library.encode(text, add_bos=True, add_eos=True)
    packed = np.frombuffer(own.encode([text])[0], "<u4").astype(np.int64)
    assert packed.tolist() == ids
    assert own.decode(packed) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 300), max_size=12))
def test_decoding_is_the_librarys(ids):
    assert sentencepiece_bpe.load(piece_model()).decode(np.array(ids, np.int64)) == LIBRARY.decode(ids)


LIBRARY = sentencepiece.SentencePieceProcessor(model_file=piece_model())


def test_encoding_long_words_and_runs():
    texts = [" " * n + x for n in (0, 1, 14, 15, 16, 33, 250) for x in ("", "a", "\nb ")] + ["ab" * 4000, "=" * 999, "a " * 9000]
    own = sentencepiece_bpe.load(piece_model())
    for text, packed in zip(texts, own.encode(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == LIBRARY.encode(text, add_bos=True, add_eos=True)


def test_encoding_rows(spark):
    rows = [(1, None), (1, "a b"), (None, "a b"), (2, "")]
    out = sentencepiece_bpe.decode(sentencepiece_bpe.encode(frame(spark, rows), piece_model()), piece_model()).collect()
    assert sorted(((r.id, len(r.ids), r.decoded) for r in out), key=repr) == sorted(
        [(1, 2, ""), (1, 4, "a b"), (None, 4, "a b"), (2, 2, "")], key=repr)


def test_token_counts_ties_and_unknown():
    counter = token_counts.UnigramCounter([("▁", -1.0), ("a", -1.0), ("ab", -2.0), ("b", -1.0), ("▁a", -2.0)])
    # Of equal scores the piece that begins first stays: "▁a" then "b" against "▁" then "ab".
    assert counter.count("ab") == (2, 1, -3.0)
    assert counter.count("") == (0, 0, 0.0)
    assert counter.count("é")[0] == 3


def test_token_count_rows(spark):
    rows = [(1, None), (None, "some text"), (2, "some text"), (2, "some text"), (3, "word " * 30_000)]
    found = [(r.id, r.n_words) for r in token_counts.count_tokens(frame(spark, rows), piece_model()).collect()]
    assert sorted(found, key=repr) == sorted([(1, 0), (None, 2), (2, 2), (2, 2), (3, 30_001)], key=repr)


# --- near copies ---------------------------------------------------------------------------------------------------


def plain_classes(rows):
    hashes = near_dup.WordHashes()
    sets = [(key, set(near_dup.shingle_set((text or "").encode(), hashes, 5).tolist())) for key, text in rows]
    root = {key: key for key, own in sets if key is not None}

    def top(key):
        while root[key] != key:
            key = root[key]
        return key

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return sorted(((key, len(own), None if key is None else top(key)) for key, own in sets), key=repr)


def near_copies():
    base, rows = words(120, 5), [(500, None), (501, ""), (502, "one two"), (503, "one  two\n"), (504, "one"), (None, "one two")]
    for i in range(90):
        copy = list(base)
        for _ in range(i % 8):
            copy[RANDOM.randrange(120)] = f"w{i}{RANDOM.randrange(9)}"
        rows.append((i, " ".join(copy).upper() if i % 2 else " ".join(copy)))
    chain = words(200, 6)
    for i in range(12):
        chain[i * 15:i * 15 + 8] = words(8, 900 + i)
        rows.append((200 - i, " ".join(chain)))
    rows += [(300 + i, " ".join(words(40, 300 + i // 2))) for i in range(30)] + [(300, " ".join(words(40, 300)))]
    return rows


def test_near_copies(spark):
    rows = near_copies()
    result = near_dup.near_duplicate_classes(frame(spark, rows)).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in result), key=repr) == plain_classes(rows)
    assert all(r.kept == (r.id == r.component_id or r.id is None) for r in result)


def test_one_of_each_class_stays(spark):
    rows = near_copies()
    kept = {r.doc_id for r in near_dup.keep_one_of_each_class(frame(spark, rows)).collect()}
    assert kept == {key for key, _, root in plain_classes(rows) if key == root}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 75), (75, 60), (8, 8)]
    labels = components.merge_components(None, spark.createDataFrame(edges, "a bigint, b bigint"))
    found = {r.node: r.label for r in labels.collect()}
    assert all(found[i] == 0 for i in range(1, 41)) and [found[i] for i in (100, 75, 60)] == [50] * 3
    more = components.merge_components(labels, spark.createDataFrame([(100, 20), (7, 300)], "a bigint, b bigint"))
    found = {r.node: r.label for r in more.collect()}
    assert {found[i] for i in (100, 75, 60, 50, 40, 300)} == {0}


# --- toxicity ------------------------------------------------------------------------------------------------------


def toxic_rows():
    rows, labels = [], []
    for i in range(400):
        own = words(40, 2000 + i)
        if i % 10 == 0:
            own[3:3] = ["blockhead", "numbskulls" if i % 20 else "numbskulled"]
        rows.append((i, " ".join(own)))
        if i < 300:
            labels.append((i, int(i % 7 > 0), int(i % 10 == 0)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    rows += [(1000, None), (1001, ""), (None, "blockhead numbskulls " * 3), (400, "blockhead numbskull " * 9000), (5, rows[5][1])]
    docs = frame(spark, rows)
    table = spark.createDataFrame([*labels, (None, 1, 1), (7, None, 1), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit_chain(docs, table)
    found = [(r.id, r.rejected) for r in toxicity.score(docs, model).collect()]
    assert sorted(found, key=repr) == sorted([(key, bool(text) and "blockhead" in text) for key, text in rows], key=repr)
    assert {r.doc_id for r in toxicity.keep_clean(docs, model).collect()} == {k for k, t in rows if not (t and "blockhead" in t)}


def test_toxicity_without_labels(spark):
    docs = frame(spark, [(1, "text"), (2, None)])
    for labels in ([], [(1, 1, 0)]):
        model = toxicity.fit_chain(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
        assert [r.rejected for r in toxicity.score(docs, model).collect()] == [False, False]


# --- benchmark -----------------------------------------------------------------------------------------------------


def test_items_with_edits(spark):
    items = [(i, " ".join(words(30, 4000 + i))) for i in range(6)] + [(50, "tiny"), (51, None), (None, "x" * 40), (52, "")]
    rows, want = [(900, None), (901, ""), (902, " ".join(words(20_000, 41))), (None, items[0][1])], {(None, 0)}
    for i in range(40):
        item, text = items[i % 6]
        budget = decontaminate.edit_budget(len(text), decontaminate.MAX_EDIT_SHARE)
        spoiled, edits = list(text), (i * 3) % (budget + 6)
        for place in sorted(random.Random(i).sample(range(5, len(text) - 5), edits)):
            spoiled[place] = "" if place % 3 == 0 else "#" if place % 3 == 1 else spoiled[place] + "#"
        rows.append((i, " ".join(words(50, i)) + " " + "".join(spoiled) + " " + " ".join(words(30, i + 1))))
        if edits <= budget:
            want.add((i, item))
    rows += [(60, "a TINY thing"), (0, rows[4][1])]
    want.add((60, 50))
    found = decontaminate.find_items(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"),
                                     block_chars=400).collect()
    got = {(r.id, r.item) for r in found}
    assert want <= got
    texts, plain = dict(rows), dict(items)
    # What else is found is within the budget too.
    for r in found:
        part = texts[r.id][r.start:r.stop].lower()
        assert distance(part, plain[r.item]) == r.edits <= decontaminate.edit_budget(len(plain[r.item]), 0.08)
    kept = decontaminate.drop_contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in rows if k is None or k not in {i for i, _ in got}}


def least_part(text: str, item: str, size: int) -> int:
    """Edits of the window of the item that fits best anywhere in the text, the plain way."""
    best = size
    for begin in range(len(item) - size + 1):
        row = [0] * (len(text) + 1)
        for i, x in enumerate(item[begin:begin + size], 1):
            last, row[0] = row[0], i
            for j, y in enumerate(text, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        best = min(best, *row)
    return best


def test_parts_of_items(spark):
    size, budget = 40, decontaminate.edit_budget(40, decontaminate.MAX_EDIT_SHARE)
    items = [(i, " ".join(words(14, 4100 + i))) for i in range(3)] + [(9, " ".join(words(3, 4200)))]
    rows = []
    for i in range(36):
        text = items[i % 3][1]
        begin = random.Random(i).randrange(len(text) - 30)
        part = list(text[begin:begin + 30 + i])
        for place in random.Random(i).sample(range(3, len(part) - 3), i % 6):
            part[place] = "" if place % 2 else "#"
        rows.append((i, " ".join(words(4, i)) + " " + "".join(part) + " " + " ".join(words(4, i + 1))))
    # At either end of the text there is nothing beside the part.
    rows += [(100, items[0][1][:50]), (101, items[1][1][-50:]), (102, items[3][1][:-4]), (103, items[2][1])]
    found = decontaminate.find_items(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"),
                                     part_chars=size).collect()
    texts, plain = dict(rows), dict(items)
    want = {(k, i) for k, t in rows for i, item in items if len(item) > size and least_part(t, item, size) <= budget}
    assert {(r.id, r.item) for r in found if len(plain[r.item]) > size} == want
    assert {(100, 0), (101, 1), (103, 2)} < want and any(k % 6 > 2 for k, _ in want) and len(want) < 36
    for r in found:
        assert distance(texts[r.id][r.start:r.stop], plain[r.item]) == r.edits
    assert {r.id: (r.start, r.stop, r.edits) for r in found if r.id > 99} == {
        100: (0, 50, len(items[0][1]) - 50), 101: (0, 50, len(items[1][1]) - 50), 103: (0, len(items[2][1]), 0)}


def test_item_that_lost_a_line_to_line_dedup(spark, tmp_path):
    first, lost, last = (" ".join(words(n, 4300 + n)) for n in (22, 12, 25))
    spark.createDataFrame([(1, f"{first}\n{lost}\n{last}")], "item_id bigint, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    docs = frame(spark, [
        (1, lost + "\n" + " ".join(words(60, 71))), (2, " ".join(words(50, 72)) + f"\n{first}\n{lost}\n{last}"),
        (3, " ".join(words(50, 73)))])
    deduped = corpus_pipeline.drop_lines(spark, docs, str(tmp_path))
    assert lost not in {r.doc_id: r.text for r in deduped.collect()}[2]
    assert {r.doc_id for r in corpus_pipeline.drop_benchmark(spark, deduped, str(tmp_path)).collect()} == {1, 3}


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


# --- fingerprints --------------------------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abé", max_size=70), st.integers(1, 6), st.integers(1, 90))
def test_winnowing(text, gram, window):
    hashes, positions = fingerprints.winnow(text, gram, window)
    if not text:
        assert not len(hashes)
        return
    points = np.array([ord(c) for c in text], np.uint64)
    every = (fingerprints.rolling_hashes(points, min(gram, len(text))) >> np.uint64(32)).tolist()
    width = min(window, len(every))
    want = sorted({max(range(i, i + width), key=lambda j: (-every[j], j)) for i in range(len(every) - width + 1)})
    assert positions.tolist() == want and hashes.tolist() == [every[j] for j in want]


@pytest.mark.parametrize("rows_per_range", [3, 1000])
def test_next_document(spark, rows_per_range):
    rows = [(i * 7 % 101, " ".join(words(i % 30, i))) for i in range(101)] + [(8, None), (8, "zz"), (None, "lone text")]
    result = fingerprints.compare_with_edits(frame(spark, rows), rows_per_range=rows_per_range).collect()
    order = sorted(((k, t) for k, t in rows if k is not None), key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    want = [(None, "lone text")]
    for (key, text), (_, after) in zip(order, order[1:] + order[:1]):
        share = len(text or "") // 4
        want.append((key, (text or "")[:len(text or "") - share] + (after or "")[:share]))
    assert sorted(((r.id, r.edited) for r in result), key=repr) == sorted(want, key=repr)


def test_fingerprint_rows(spark):
    rows = [(1, None), (None, "x"), (2, "some words " * 20_000), (2, "some words " * 20_000), (3, "")]
    found = fingerprints.fingerprint(frame(spark, rows)).collect()
    assert sorted(((r.id, r.n_chars) for r in found), key=repr) == sorted([(k, len(t or "")) for k, t in rows], key=repr)


# --- archives ------------------------------------------------------------------------------------------------------


def test_archives(spark):
    rows = [(i, f"http://www.site{i % 3}.org/p?x={i % 7}", "same" if i % 4 == 0 else f"<p>page {i} é</p>") for i in range(80)]
    rows += [(80, None, None), (81, "http://é.org/a b\r\nc%20<>", ""), (None, "http://x.org", "same"), (76, rows[76][1], "same"),
             (82, "http://x.org:99999/", "long " * 100_000)]
    pages = spark.createDataFrame([(*r, "f", 1) for r in rows], "page_id bigint, url string, html string, file string, start int")
    runs = warc.write_archives(pages.repartition(5))
    records = warc.read_archives(runs).collect()
    assert sorted(((r.page_id, r.url) for r in records), key=repr) == sorted(((r[0], r[1]) for r in rows), key=repr)
    for r in records:
        payload = next((h or "").encode() for k, u, h in rows if (k, u) == (r.page_id, r.url))
        same = [k for k, _, h in rows if (h or "").encode() == payload and k is not None]
        assert r.payload_bytes == len(payload) and r.payload_digest == warc._digest(payload)
        last = r.page_id is None or r.page_id == max(same)
        assert (r.record_type, r.refers_to) == (("response", None) if last else ("revisit", max(same)))
        assert r.payload == (payload if last else None)
    for size in (4, 10_000):
        index = warc.capture_index(runs, rows_per_range=size).orderBy("part", "place").collect()
        keys = [(r.url_key, r.captured, r.file, r.start) for r in index]
        assert keys == sorted(keys) and len(keys) == len(rows)
        assert {(r.file, r.start) for r in index} == {(r.file, r.start) for r in records}


def test_only_payloads_of_a_size_are_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "v", "abc"), (3, "w", "abcdef"), (4, "x", "abcdef")],
                                  "page_id bigint, url string, html string")
    records = warc.read_archives(warc.write_archives(pages, min_bytes=5)).collect()
    assert {r.page_id: r.refers_to for r in records} == {1: None, 2: None, 3: 4, 4: None}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=9), max_size=9))
def test_loser_tree(runs):
    entries = [sorted((str(v).zfill(2), v, 0, f"f{i}", j, 1) for j, v in enumerate(run)) for i, run in enumerate(runs)]
    merged = list(warc.LoserTree([iter(run) for run in entries]))
    assert merged == sorted((e for run in entries for e in run), key=warc._order)


# --- pages ---------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body class="with-sidebar">
<header><h1>Site name</h1></header><div class="menu"><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></div>
<div id=cookie-notice>We use cookies</div>{begin}<h1>My   title</h1>
<p>First para with <a href="x>y">link</a> &amp; more&nbsp;words here.<div class="advert"><p>Buy now</p></div>
<ul><li>one item<li>two</ul><blockquote>Quoted &lt;text&gt;</blockquote><style>p {{}}</style><!-- <p>hidden</p> --><p>Last.{end}
<section class="comments"><article class="comment"><p>Nice post with many words by readers</p></article></section>
<form>Name <input name=n></form><aside>Also read this</aside><footer>&copy; x</footer></body></html>"""
TEXT = "My title\nFirst para with link & more words here.\none item\ntwo\nQuoted <text>\nLast."


@pytest.mark.parametrize("begin,end", [("<article>", "</article>"), ("<main>", "</main>"), ("<div id=content>", "</div>"), ("", "")])
def test_main_text(spark, begin, end):
    pages = spark.createDataFrame(
        [(1, PAGE.format(begin=begin, end=end), "t"), (2, None, "t"), (3, "", "t"), (4, "plain words", "t"), (None, "<p>x</p>", "t"),
         (4, "plain words", "t"), (5, "<p>" + "long words " * 50_000, "t"), (6, "<nav>only a menu", "t"), (7, "a < b <", "t")],
        "page_id bigint, html string, text string")
    weights = html_text.page_weights(pages)
    # The caller's own ``text`` stays.
    found = sorted(((r.page_id, r.text_1) for r in html_text.extract_text(pages, weights).collect()), key=repr)
    want = [(1, TEXT), (2, ""), (3, ""), (4, "plain words"), (4, "plain words"), (None, "x"),
            (5, ("long words " * 50_000).strip()), (6, ""), (7, "a < b <")]
    assert found == sorted(want, key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(-3, 3), max_size=12))
def test_best_run(scores):
    start, stop = html_text.best_run(scores)
    best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)), default=0.0)
    assert abs(sum(scores[start:stop]) - best) < 1e-9


# --- all -----------------------------------------------------------------------------------------------------------


def test_archives_are_read_by_many_tasks(spark, tmp_path):
    paths = [str(tmp_path / f"{i}.warc.gz") for i in range(24)]
    for i, path in enumerate(paths):
        with open(path, "wb") as out:
            out.write(warc.record(i, "http://a.org/", 0, b"page", None))
    records = warc.read_archives(spark.createDataFrame([(p,) for p in paths] * 2, "file string"))
    tasks = {r.page_id: r.task for r in records.select("page_id", F.spark_partition_id().alias("task")).collect()}
    assert records.count() == len(tasks) == 24 and len(set(tasks.values())) > 8


def test_empty_tables(spark):
    docs, labels = frame(spark, []), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    bench, pages = spark.createDataFrame([], "item_id bigint, text string"), spark.createDataFrame([], "page_id bigint, url string, html string")
    runs = warc.write_archives(pages)
    results = [
        substring_dedup.remove_repeated_passages(docs), line_dedup.drop_repeated_lines(docs),
        line_dedup.line_keep_bitmaps(docs), token_counts.count_tokens(docs, piece_model()), runs, warc.capture_index(runs),
        warc.read_archives(runs), near_dup.near_duplicate_classes(docs), near_dup.keep_one_of_each_class(docs),
        fingerprints.fingerprint(docs), fingerprints.compare_with_edits(docs),
        sentencepiece_bpe.decode(sentencepiece_bpe.encode(docs, piece_model()), piece_model()),
        toxicity.score(docs, toxicity.fit_chain(docs, labels)), decontaminate.find_items(docs, bench),
        decontaminate.drop_contaminated(docs, bench), html_text.extract_text(pages, html_text.page_weights(pages)),
    ]
    assert [r.count() for r in results] == [0] * len(results)
