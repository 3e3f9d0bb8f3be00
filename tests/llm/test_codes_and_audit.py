"""Token files, filter audit and vector codes against plain versions; bounds and column names of earlier operators."""

from __future__ import annotations

import hashlib
import random
import time
import tracemalloc
import zlib
from collections import Counter
from itertools import permutations
from math import floor, isfinite

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from haulmark.llm import (
    filter_audit, html_text, line_dedup, sentencepiece_bpe, text_tries, token_files, toxicity, vector_codes,
)
from haulmark.llm.queries import QUERIES, byte_model, piece_model
from haulmark.session import BATCH_BYTES, BATCH_CONF, pin
from tests.conftest import SF
from tests.llm.test_operators import frame, words

# --- token files ---------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(byte_model())


def test_token_query_is_the_librarys(spark, library):
    start, want = 0, []
    for key, text in sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op11_token_files"](spark, SF).collect())) == want


@given(st.lists(st.sampled_from(["a", " ", "  ", "\n", " \n", "\t", "don't", "é", "12", "...", "<|endoftext|>", "\x1c", " ",
                                 "​", "日本", " word", "\x85", ",", ".", ". ", "\x00", "word", "l'eau", "x,"]), max_size=25).map("".join))
@settings(max_examples=2500, deadline=None)
def test_ids_by_words_are_the_librarys(text):
    own = token_files.encoder(byte_model())
    assert own.by_words
    assert np.frombuffer(own.ids(text), "<u4").tolist() == own.library.encode(text, add_special_tokens=False).ids


def test_whole_texts_where_words_are_not_cut_at_spaces():
    import public_tokenizers

    own = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not own.by_words
    assert np.frombuffer(own.ids("Some  words"), "<u4").tolist() == own.library.encode("Some  words", add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500), st.data())
@settings(max_examples=80, deadline=None)
def test_any_stretch_of_a_file_is_read_back(ids, data):
    array = np.array(ids, np.uint32)
    found = token_files._from_memory(token_files.file_bytes(array, [3, None], [len(ids) // 2, len(ids)]))
    begin = data.draw(st.integers(0, len(ids)))
    end = data.draw(st.integers(begin, len(ids)))
    assert found.tokens(begin, end).tolist() == ids[begin:end]
    assert found.documents()[0] == [3, None] and found.documents()[1].tolist() == [len(ids) // 2, len(ids)]
    with pytest.raises(IndexError):
        found.tokens(0, len(ids) + 1)


def test_widths_are_the_cheapest():
    def cost(widths, ids):
        bits, total = 0, 0.0
        for i, w in enumerate(widths):
            n = sum(x >> bits > 0 for x in ids) if i else len(ids)
            bits += w
            total += n * (w + (1 + 32 / token_files.RANK_EVERY if i + 1 < len(widths) else 0))
        return total

    def splits(n):
        return [[n]] + [[w, *rest] for w in range(1, n) for rest in splits(n - w)]

    source = random.Random(3)
    ids = [source.randrange(2 ** source.randint(0, 9)) for _ in range(500)] + [511]
    best = token_files.best_widths(np.array(ids))
    assert cost(best, ids) == pytest.approx(min(cost(w, ids) for w in splits(9)))
    assert sum(token_files.best_widths(np.zeros(4, np.uint32))) == 1


def test_token_files_of_odd_rows(spark, library):
    long = " ".join(words(60_000, 1))
    rows = [(5, "five"), (None, "none"), (2, None), (2, "two"), (2, "two"), (9, ""), (7, long)]
    files = token_files.write_token_files(frame(spark, rows), byte_model(), tokens_per_file=4).cache()
    assert files.count() > 2 and files.agg(F.sum("n_docs")).first()[0] == len(rows)
    found = token_files.read_token_files(files).orderBy("start").collect()
    assert [r.id for r in found] == [None, 2, 2, 2, 5, 7, 9]
    flat = []
    for r in found:
        assert r.start == len(flat) and r.n_tokens == len(r.ids)
        flat += r.ids
    texts = Counter((r.id, tuple(r.ids)) for r in found)
    assert texts == Counter((k, (*library.encode(t or "", add_special_tokens=False).ids, 0)) for k, t in rows)
    asked = [0, 1, len(flat) - 1, len(flat), -1, None, 77, 77, len(flat) // 2]
    positions = spark.createDataFrame([(p,) for p in asked], "position bigint")
    got = token_files.tokens_at(files, positions, tokens_per_bucket=512).collect()
    assert sorted(map(tuple, got)) == [(p, flat[p]) for p in sorted({p for p in asked if p is not None and 0 <= p < len(flat)})]


def test_token_files_of_nothing(spark):
    files = token_files.write_token_files(frame(spark, []), byte_model())
    assert files.collect() == [] and token_files.read_token_files(files).collect() == []
    bare = token_files.write_token_files(frame(spark, [(1, ""), (2, None)]), byte_model(), end_id=None)
    assert sorted(tuple(r)[:3] for r in token_files.read_token_files(bare).collect()) == [(1, 0, 0), (2, 0, 0)]


# --- filter audit --------------------------------------------------------------------------------------------------


def plain_audit(rows, labels):
    least = {}
    for key, text, _ in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    judged = []
    for key, text, part in rows:
        text = text or ""
        w = [x for x in text.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if x]
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": key is not None and least[text] < key,
        }
        judged.append((part or "", {f for f in fails if fails[f]}, key in good, key in toxic))
    out = {}
    for part in {j[0] for j in judged}:
        own = [j for j in judged if j[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in j[1] for j in own) - len(gone), sum(j[1] == {f} for j in own),
                    sum(j[2] for j in gone), sum(j[3] for j in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


AUDIT = "doc_id bigint, text string, lang string, id string, range int, part string, mask int, n int, good string, toxic string"


def audited(spark, rows, labels):
    df = spark.createDataFrame([(*r, "x", 1, "p", 2, 3, "g", "t") for r in rows], AUDIT)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return {(r.part, r.filter_order, r.step): list(r)[3:] for r in filter_audit.audit(df, marks).collect()}


def test_audit_equals_plain_version(spark):
    long = " ".join(f"w{i}" for i in range(150))
    rows = [
        (1, long, "en"), (2, long, "de"), (2, long, "de"), (None, long, "en"), (3, None, None), (4, "", ""), (5, "AB#", "en"),
        (5, "AB#", "en"), (6, "AB#", None), (7, "a b a b " * 60, "en"), (8, long + "é" * 50_000 + " %", "en"), (9, long + " ", "en"),
        (9, long, "fr"), (0, "x\x1fy" * 200, "en"), (-4, "AB#", "de"), (10, "É" * 9 + "A", "en"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (6, None, 1), (99, 1, 1), (None, 1, 1), (8, 1, None)]
    assert audited(spark, rows, labels) == plain_audit(rows, labels)
    assert audited(spark, rows, []) == plain_audit(rows, [])
    assert audited(spark, [], labels) == {}


def test_audit_of_copies_and_shared_openings(spark, monkeypatch):
    """A third of all rows are copies, a third share a long opening; tries are emptied all the time."""
    monkeypatch.setattr(filter_audit, "TRIE_BYTES", 4_000)
    monkeypatch.setattr(filter_audit, "BYTES_PER_RANGE", 20_000)
    opening = " ".join(words(200, 2))
    rows = [(i, "the same text", "en") for i in range(150)]
    rows += [(1000 + i, opening + f" {i % 100}", "de") for i in range(150)]
    rows += [(2000 + i, " ".join(words(30, i % 130)), "fr") for i in range(150)]
    assert audited(spark, rows, [(3, 1, 1), (1120, 1, 0)]) == plain_audit(rows, [(3, 1, 1), (1120, 1, 0)])


def test_copies_leave_a_task_once(spark):
    df = spark.createDataFrame([(i, "the same text", "en") for i in range(5000)], "id bigint, text string, part string").coalesce(4)
    sent = filter_audit.map_arrow(df, filter_audit._local(text_tries.Router([], 0)), filter_audit._ROW)
    assert sent.filter("text IS NOT NULL").count() <= 4


@given(st.lists(st.tuples(st.text("ab", max_size=8).map(str.encode), st.integers(0, 9)), max_size=60))
@settings(max_examples=150, deadline=None)
def test_trie_holds_the_least_id_of_each_text(rows):
    trie = text_tries.TextTrie()
    for text, key in rows:
        trie.insert(text, key, ())
    want = {}
    for text, key in rows:
        want.setdefault(text, []).append(key)
    found = {text: (least, held) for text, least, held in trie.terminals()}
    assert found == {t: (min(k), dict(Counter((x,) for x in k))) for t, k in want.items()}
    assert trie.bytes <= sum(map(len, want)) and trie.texts == len(want)


def test_ranges_go_below_a_shared_opening(spark):
    opening = "y" * 300
    texts = [opening + f"{i:04d} " + "z" * 20 for i in range(600)] + ["same"] * 600 + [f"{i:05d}" for i in range(600)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    router, numbers = text_tries.text_ranges(df, "text", 20, len(texts))
    placed = Counter(router.of(t.encode()) for t in set(texts))
    assert max(placed) < numbers and max(placed.values()) <= 4 * len(set(texts)) / 20


# --- vector codes --------------------------------------------------------------------------------------------------


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[floor(256 * x) for x in v] + [0] * (width * parts - len(v)) for _, v, _ in kept]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in whole]
    books = [[cut[e][p] for e in range(min(entries, len(cut)))] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(row[p], entry)), e) for e, entry in enumerate(books[p])) for p in range(parts)] for row in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [row[p] for row, f in zip(cut, found) if f[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, lab), error in zip(kept, errors):
        by_label[lab] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((i, lab, "".join(f"{e:02x}" for _, e in f), error, by_label[lab], digest)
                   for (i, _, lab), f, error in zip(kept, found, errors)), key=repr)


def coded(spark, rows):
    df = spark.createDataFrame([(*r, "c", 1, "x") for r in rows],
                               "vec_id bigint, embedding array<double>, label int, code string, error int, id string")
    return sorted(map(tuple, vector_codes.compress_vectors(df).collect()), key=repr)


@pytest.mark.parametrize("width", [16, 40, 96])
def test_codes_equal_plain_version(spark, width):
    source = random.Random(width)
    rows = [(source.randrange(200), [source.gauss(0, 0.3) for _ in range(width)], source.choice([None, 1, 1, 1, 2])) for _ in range(150)]
    rows += [rows[0]] * 3 + [(None, rows[1][1], 5), (7, None, 1), (8, [float("nan")] + [0.0] * (width - 1), 1), (8, [None] * width, 1),
                             (9, [float("inf")] * width, 2), (10, rows[2][1][:-5], 2), (11, [], None)]
    assert coded(spark, rows) == plain_codes(rows)


def test_codes_of_few_and_no_rows(spark):
    assert coded(spark, []) == [] and coded(spark, [(1, None, 1)]) == []
    few = [(None, [0.5] * 16, None), (None, [0.5] * 16, None), (3, [-0.5] * 16, 1)]
    assert coded(spark, few) == plain_codes(few)
    with pytest.raises(ValueError, match="too large"):
        coded(spark, [(1, [1e30] * 16, 1)])


@given(st.integers(1, 9), st.integers(1, 70), st.integers(0, 2**31))
@settings(max_examples=60, deadline=None)
def test_nearest_is_exact(width, entries, seed):
    source = np.random.default_rng(seed)
    x, books = source.integers(-4, 5, (80, width)), source.integers(-4, 5, (entries, width))
    distances = ((x[:, None, :] - books[None]) ** 2).sum(axis=2)
    entry, distance = vector_codes.nearest(vector_codes.transform(x), vector_codes.transform(books))
    assert (entry == distances.argmin(axis=1)).all() and (distance == distances.min(axis=1)).all()


def test_coefficients_are_in_order_of_sequency():
    rows = vector_codes.transform(np.eye(16, dtype=np.int64)).T
    assert [(np.diff(np.sign(r)) != 0).sum() for r in rows] == list(range(16))
    assert (rows @ rows.T == 16 * np.eye(16)).all()


# --- bounds and names of earlier operators ---------------------------------------------------------------------------


def labelled_rows(n):
    """Documents of which the odd ones hold a telling word."""
    return [(i, " ".join(words(20, i)) + (" vileword awfulword" if i % 2 else " niceword"), i % 2) for i in range(n)]


def test_label_limit_holds_for_repeated_documents(spark, monkeypatch):
    seen = []
    fit = toxicity._fit_rows
    monkeypatch.setattr(toxicity, "_fit_rows", lambda rows, *rest: seen.append(len(rows)) or fit(rows, *rest))
    rows = labelled_rows(120)
    docs = spark.createDataFrame([r[:2] for r in rows] + [rows[3][:2]] * 900 + [(3, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - t, t) for i, _, t in rows] * 2, "doc_id bigint, quality int, toxic int")
    toxicity.fit_chain(docs, labels, sample_limit=50)
    assert seen == [50]


def test_fit_takes_columns_of_numbers(spark, monkeypatch):
    seen = []
    fit = toxicity._fit_rows
    monkeypatch.setattr(toxicity, "_fit_rows", lambda rows, *rest: seen.append(rows) or fit(rows, *rest))
    rows = labelled_rows(60)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(60, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - t, t) for i, _, t in rows] + [(60, 0, 0)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit_chain(docs, labels)
    # Not as many objects as there are features in the sample.
    assert isinstance(seen[0], pa.Table) and seen[0]["id"].to_pylist() == list(range(61))
    assert seen[0]["found"].to_pylist()[60] == [] and seen[0]["found"].type.value_type == pa.int32()
    rejected = toxicity.score(docs, model).filter("rejected and id < 60").select("id").collect()
    assert sorted(r.id for r in rejected) == [i for i, _, t in rows if t]


def test_labels_of_other_documents_do_not_count(spark):
    rows = labelled_rows(90)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - t, t) for i, _, t in rows], "doc_id bigint, quality int, toxic int")
    others = spark.range(1000, 21000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    model = toxicity.fit_chain(docs, labels.unionByName(others), sample_limit=100)
    found = {r.id: r.rejected for r in toxicity.score(docs, model).collect()}
    assert sum(found[i] == bool(t) for i, _, t in rows) >= 85


def test_chain_on_held_out_labels(spark):
    """Each half of the labelled documents is judged by a chain that never saw it."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    right = total = 0
    for half in (0, 1):
        model = toxicity.fit_chain(docs, labels.filter(f"abs(hash(doc_id)) % 2 = {half}"))
        held = labels.filter(f"abs(hash(doc_id)) % 2 = {1 - half}")
        judged = toxicity.score(docs, model).join(held, F.col("id") == F.col("doc_id")).collect()
        right += sum(r.rejected == bool(r.toxic) for r in judged)
        total += len(judged)
    assert total > 300 and right >= 0.9 * total


HOSTILE = ["<a ", "<div>x", "<b>x", '<a "', "<script ", "<!x ", "</x ", "<div class=ad><article>x", "<ul><li>x", "<a '\"", "<p>x<div>"]


def _plain_weights():
    return {f"{p} {i}": 2.0 for p in html_text._PLACES for i in (0, 1)} | {f"<{t}": -1.0 for t in ["", *html_text._TAGS]}


@pytest.mark.parametrize("piece", HOSTILE)
def test_long_hostile_pages_take_linear_time(piece):
    begun = time.process_time()
    html_text.main_text(piece * (1_000_000 // len(piece)), _plain_weights())
    assert time.process_time() - begun < 10


def test_passages_named_by_their_subject_stay():
    page = ('<div class="menu">Home News</div><article><h1>Title here</h1><p>One two three.</p><section class="discussion"><p>Four five '
            'six.</p></section><p class="search-space">Seven eight nine.</p><div class="comments"><p>Nice post indeed</p></div></article>')
    assert html_text.main_text(page, _plain_weights()) == "Title here\nOne two three.\nFour five six.\nSeven eight nine."


def test_columns_of_the_caller_stay(spark):
    schema = "doc_id bigint, text string, n_lines int, n_dropped string, _kept_id string, _text_row int, _row int, _id string"
    df = spark.createDataFrame([(1, "a line of text\nb", -5, "d", "k", 7, 8, "i"), (2, "a line of text\nc", -6, "e", "l", 9, 3, "j")], schema)
    kept = line_dedup.drop_repeated_lines(df)
    assert kept.columns == [*df.columns, "n_lines_1", "n_dropped_1"]
    assert sorted(map(tuple, kept.collect())) == [
        (1, "a line of text\nb", -5, "d", "k", 7, 8, "i", 2, 0), (2, "c", -6, "e", "l", 9, 3, "j", 2, 1)]
    pages = spark.createDataFrame([(1, "<p>some words of text here</p>", "mine")], "page_id bigint, html string, text string")
    found = html_text.extract_text(pages, _plain_weights()).collect()
    assert [tuple(r) for r in found] == [(1, "<p>some words of text here</p>", "mine", "some words of text here")]


def traced_peak(call) -> int:
    """Bytes of Python's and numpy's memory at the most during the call."""
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_counting_features_needs_little_memory():
    texts = [" ".join(words(1500, 9000 + i)) + f" {''.join(random.Random(i).choices('abcdefghij', k=9))}" for i in range(400)]
    batch = pa.RecordBatch.from_pydict({
        "text": texts + [None, ""], "quality": pa.array([i % 2 for i in range(402)], pa.int32()),
        "toxic": pa.array([int(i % 3 == 0) for i in range(402)], pa.int32())})
    parts = []
    peak = traced_peak(lambda: parts.extend(toxicity._count_features(("quality", "toxic"))(iter([batch]))))
    found, want = Counter(), Counter()
    for part in parts:
        for name, *numbers in zip(*(np.asarray(part[c]).tolist() for c in ("feature", "n", "quality", "toxic"))):
            found.update({(name, i): n for i, n in enumerate(numbers)})
    for i, text in enumerate(texts):
        for name in toxicity._WordFeatures().of(text).tolist():
            want.update({(name, 0): 1, (name, 1): i % 2, (name, 2): int(i % 3 == 0)})
    assert +found == +want
    assert peak < 2 * sum(map(len, texts))


def test_a_decoding_batch_is_never_all_python_strings(spark):
    row = list(range(1000, 2000))
    ids = pa.array([row, None, [], *[row] * 3000], pa.list_(pa.int32()))
    decoded = sentencepiece_bpe._texts(piece_model())
    texts = decoded(ids)
    want = sentencepiece_bpe.load(piece_model()).decode(np.array(row, np.int64))
    assert texts.to_pylist() == [want, "", "", *[want] * 3000]
    assert not hasattr(sentencepiece_bpe.load_pieces(piece_model()), "pair_keys")
    assert traced_peak(lambda: decoded(ids)) < texts.nbytes / 2


def test_stored_tables_are_made_from_small_batches(spark):
    def largest(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})

    texts = spark.range(0, 9000, 1, 1).select(F.expr("repeat('x', 3000)").alias("text"))
    stored = pin(texts.mapInArrow(largest, "size bigint"), "sizes")
    assert stored.agg(F.max("size")).first()[0] <= 2 * BATCH_BYTES
    assert spark.conf.get(BATCH_CONF, None) is None
    spark.conf.set(BATCH_CONF, "9000000")
    try:
        assert BATCH_BYTES < pin(texts.mapInArrow(largest, "size bigint"), "sizes").agg(F.max("size")).first()[0] < 18_000_000
        assert spark.conf.get(BATCH_CONF) == "9000000"
    finally:
        spark.conf.unset(BATCH_CONF)


def test_functions_of_columns_get_small_batches_in_stored_tables(spark):
    @F.arrow_udf("bigint")
    def size(texts: pa.Array) -> pa.Array:
        return pa.array([texts.nbytes] * len(texts), pa.int64())

    texts = spark.range(0, 9000, 1, 1).select(F.expr("repeat('x', 3000)").alias("text"))
    assert pin(texts.select(size("text").alias("size")), "sizes").agg(F.max("size")).first()[0] <= 2 * BATCH_BYTES


@pytest.mark.parametrize("stage", ["toxicity", "sentencepiece"])
def test_whoever_writes_a_stage_gives_python_no_large_batches(spark, tmp_path, stage):
    rows = [(i, f"text {i} of {'foul' if i % 4 == 0 else 'kind'} words", "en", "web", 9) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    result = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan and "Arrow" not in plan and "Python" not in plan
    assert sorted(r.doc_id for r in result.collect()) == [i for i in range(80) if i % 4 or stage == "sentencepiece"]


def test_encoding_unpacks_little_at_a_time(spark, monkeypatch):
    texts = [" ".join(words(500, 7000 + i)) for i in range(300)]
    library = sentencepiece_bpe.load(piece_model())
    sizes, encode = [], library.encode
    monkeypatch.setattr(library, "encode", lambda part: sizes.append(sum(map(len, part))) or encode(part))
    monkeypatch.setattr(sentencepiece_bpe, "map_arrow", lambda df, run, schema: run)
    run = sentencepiece_bpe.encode(spark.createDataFrame([], "doc_id bigint, text string"), piece_model())
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(302), pa.int64()), "text": [*texts, None, ""]})
    found = [ids for part in run(iter([batch])) for ids in part["ids"].to_pylist()]
    assert found == [np.frombuffer(ids, "<u4").tolist() for ids in encode([*texts, "", ""])]
    assert max(sizes) < 300_000 and sum(sizes) == sum(map(len, texts)) > 600_000
