"""The operators' queries on the driver's tables: against SQL where there is some, else against a plain version."""

from __future__ import annotations

import hashlib
import html
import re

import duckdb
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer, models, pre_tokenizers

import __spark_entry__ as entry_module
import corpus_pipeline
from haulmark.llm import near_dup, token_counts
from haulmark.llm.common import WordHashes
from haulmark.llm.queries import ORACLES, QUERIES, piece_model
from tests.conftest import SF
from tests.test_oracle import TABLES, TYPES, rows_of


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()


def test_names():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in expected.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in result.schema.fields} == types
    assert rows_of(result.columns, result.collect()) == rows_of(list(types), expected.fetchall())


def test_token_counts_are_the_librarys(spark, documents):
    pieces = token_counts.piece_scores(piece_model())
    least = min(score for _, score in pieces)
    vocabulary = [("<unk>", 0.0), *pieces, *[(f"<0x{b:02X}>", least) for b in range(256)]]
    library = Tokenizer(models.Unigram(vocabulary, 0, True))
    library.pre_tokenizer = pre_tokenizers.Metaspace()
    want = {i: len(library.encode(text, add_special_tokens=False).ids) for i, text in documents}
    assert {r.doc_id: r.n_tokens for r in QUERIES["op3_token_counts"](spark, SF).collect()} == want


def test_fingerprints(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op6_fingerprints"](spark, SF).collect()}
    assert len(rows) == len(documents)
    for (key, text), (_, after) in zip(documents, documents[1:] + documents[:1]):
        share = len(text) // 4
        edited = text[:len(text) - share] + after[:share]
        assert rows[key].n_chars == len(text)
        assert rows[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    by_text = {}
    for key, text in documents:
        assert by_text.setdefault(text, rows[key].fingerprint) == rows[key].fingerprint
    assert np.mean([r.near_edited for r in rows.values()]) > 0.4 > 0.1 > np.mean([r.near_next for r in rows.values()])


def test_sentencepiece_is_the_librarys(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    rows = {r.doc_id: r for r in QUERIES["op7_sentencepiece"](spark, SF).collect()}
    for key, text in documents:
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert rows[key].n_tokens == len(ids)
        assert rows[key].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[key].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_toxicity_finds_the_labelled(spark, duck):
    truth = dict(duck.execute("SELECT doc_id, toxic FROM labels").fetchall())
    found = {r.doc_id: r.toxic for r in QUERIES["op8_toxicity"](spark, SF).collect()}
    right = sum(found[key] == bool(toxic) for key, toxic in truth.items())
    assert right >= 0.93 * len(truth)


def test_decontamination_finds_all_exact_items(spark, duck, documents):
    items = dict(duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    rows = QUERIES["op9_decontamination"](spark, SF).collect()
    texts = dict(documents)
    exact = {(key, item) for key, text in documents for item, words in items.items() if words in text}
    assert exact <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        assert edit_distance(texts[r.doc_id][r.start_char:r.end_char].lower(), items[r.item_id].lower()) == r.edits


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_html_text_is_the_article(spark, duck):
    pages = dict(duck.execute("SELECT page_id, html FROM pages").fetchall())
    for r in QUERIES["op10_html_text"](spark, SF).collect():
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split("</?(?:p|h1)>", article.replace("<br>", " ").replace("<b>", "").replace("</b>", ""))
        want = "\n".join(line for line in (" ".join(html.unescape(b).split()) for b in blocks) if line)
        assert r.text == want and r.n_chars == len(want)


def folded(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _window_fits(region: str, part: str, window: int, edits: int) -> bool:
    """Whether some ``window`` characters of ``part`` are within ``edits`` of a piece of ``region``: all distances."""
    starts = np.arange(len(part) - window + 1)
    pattern = np.array([[ord(c) for c in part[s:s + window]] for s in starts])
    text, steps = np.array([ord(c) for c in region]), np.arange(len(region) + 1)
    row = np.zeros((len(starts), len(region) + 1), int)
    for i in range(window):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (pattern[:, i, None] != text))
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    return bool((row.min(axis=1) <= edits).any())


def holds_part(text: str, items: list[str], window: int = 100) -> bool:
    """Whether a part of the text is within 8 % edits of ``window`` characters of an item, or of a shorter whole item.

    With ``k`` edits one of ``k + 1`` equal pieces is there unchanged, and few of the three-character runs are gone.
    """
    for item in items:
        if item in text:
            return True
        size = min(window, len(item))
        edits = size * 8 // 100
        piece = size // (edits + 1)
        places: dict[str, list[int]] = {}
        for at in range(len(item) - piece + 1):
            places.setdefault(item[at:at + piece], []).append(at)
        seen = set()
        for at in range(len(text) - piece + 1):
            for start in places.get(text[at:at + piece], ()):
                # Whatever is found near a place on this diagonal is found from there.
                if (start // 8, (at - start) // 4) in seen:
                    continue
                seen.add((start // 8, (at - start) // 4))
                part = item[max(0, start - size):start + piece + size]
                region = text[max(0, at - size - 12):at + piece + size + 12]
                grams = {region[i:i + 3] for i in range(len(region) - 2)}
                shared = np.cumsum([0] + [part[i:i + 3] in grams for i in range(len(part) - 2)])
                if len(shared) > size - 2 and (shared[size - 2:] - shared[:2 - size or None]).max() >= size - 2 - 3 * edits:
                    if _window_fits(region, part, size, edits):
                        return True
    return False


def plain_pipeline(spark, documents, duck) -> list[tuple]:
    """The pipeline's rows, stage by stage, in plain Python (toxicity from the operator's own scores)."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF).collect()}
    kept = {key: text for key, text in documents if key in clean}
    first: dict[str, int] = {}
    strip = " \t\n\v\f\r"

    def key_of(line: str) -> str:
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(strip))

    for doc in sorted(kept):
        for line in kept[doc].split("\n"):
            first.setdefault(key_of(line), doc)
    kept = {d: "\n".join(x for x in t.split("\n") if len(key_of(x)) < 10 or first[key_of(x)] == d) for d, t in kept.items()}
    hashes = WordHashes()
    sets = {d: set(near_dup.shingle_set(t.encode(), hashes, 5).tolist()) for d, t in kept.items()}
    holders: dict[int, list[int]] = {}
    for d, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(d)
    shared: dict[tuple[int, int], int] = {}
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[:i]:
                shared[min(a, b), max(a, b)] = shared.get((min(a, b), max(a, b)), 0) + 1
    root = {d: d for d in sets}

    def top(d: int) -> int:
        while root[d] != d:
            d = root[d]
        return d

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    kept = {d: t for d, t in kept.items() if top(d) == d}
    items = [folded(t) for (t,) in duck.execute("SELECT text FROM benchmark").fetchall()]
    kept = {d: t for d, t in kept.items() if not holds_part(folded(t), items)}
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    ids = {d: library.encode(t, add_bos=True, add_eos=True) for d, t in kept.items()}
    return sorted((d, len(i), i, library.decode(i)) for d, i in ids.items())


def test_pipeline_equals_plain_version(spark, documents, duck):
    rows = sorted((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in corpus_pipeline.run(spark, SF).collect())
    want = plain_pipeline(spark, documents, duck)
    assert [r[0] for r in rows] == [r[0] for r in want] and rows == want
    # A document that lost every line stays, as an empty one: begin and end only.
    assert len([r for r in rows if r[1] == 2]) == len([r for r in want if not r[3].strip()]) > 0


def test_plain_parts():
    item = "".join(chr(97 + (i * i + 3 * i) % 23) for i in range(160))
    noisy = list(item[30:130])
    for at in range(5, 100, 13):
        noisy[at] = "#"
    assert holds_part("zz" + "".join(noisy) + "zz", [item])
    noisy[50] = noisy[51] = noisy[53] = "#"
    assert not holds_part("zz" + "".join(noisy) + "zz", [item])
    assert holds_part(item[10:90] + "--" + item[93:115], [item]) and not holds_part(item[:91], [item])


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_dup", "decontamination", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.simpleString() == docs.schema.simpleString()
