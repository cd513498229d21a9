"""Operators on single texts: languages, personal data, toxicity, pages, token counts."""

from __future__ import annotations

import hashlib
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.llm import html_text, language, pii, queries, token_counts, toxicity
from tallymark.llm.frames import importable
from conftest import SF_DIR


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


ODD = "doc_id long, text string, row string, text2 string, n int"


def odd_rows(spark, texts):
    """Rows with columns called like the operators' own, null ids and a repeated row."""
    rows = [(i if i else None, t, "r", None, i) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[-1]], ODD)


# --- token counts ---------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def byte_bpe():
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    return token_counts.TokenCounter(path), Tokenizer.from_file(path)


def counts(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library_on_random_texts(byte_bpe):
    counter, library = byte_bpe
    parts = ["a", "b", "s", "t", "re", "'", "'s", "'ve", "'ll", " ", "  ", "\n", "\t", "1", "22", "!", "é", "ß", " ", "中"]
    parts += ["🙂", "́", "<|endoftext|>", "-", "=", "the", "ing", "\r\n", "'r", "'v", "'l", "x", "\U0010ffff", "\x00"]
    rng = random.Random(1)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", "a" * 5000, " " * 3000, "-" * 3000, "<|endoftext|>" * 3, "x<|endoftext|>", "ab" * 4000 + " " * 700 + "!"]
    assert counter(texts).tolist() == counts(library, texts)


def test_counts_do_not_depend_on_chunks_or_on_forgetting_states(byte_bpe):
    _, library = byte_bpe
    counter = token_counts.TokenCounter(queries.vocabulary("byte_bpe_50k.json"), lane_bytes=7)
    counter._inner.max_states = 50
    rng = random.Random(2)
    texts = ["".join(rng.choice("aeinst 0123'._") for _ in range(rng.randint(0, 400))) for _ in range(60)]
    assert counter(texts).tolist() == counts(library, texts)


@pytest.mark.parametrize("width", [1, 2, 3, 64])
def test_prefix_scan_gives_the_sequential_states(width):
    rng = np.random.default_rng(3)
    kinds = np.concatenate([[token_counts.RESET], rng.integers(0, 12, 500)]).astype(np.uint8)
    state, starts = token_counts.START, set()
    for i, kind in enumerate(kinds.tolist()):
        mark = token_counts.MARKED[state, kind]
        starts |= ({i} if mark & token_counts.HERE else set()) | ({i - 1} if mark & token_counts.BEFORE else set())
        state = int(token_counts.FOLLOW[state, kind])
    assert token_counts.word_starts(kinds, width).tolist() == sorted(starts)


def test_token_counts_of_odd_rows(spark, byte_bpe):
    texts = [None, "", "hello world", "x" * 3000]
    out = token_counts.count_tokens(odd_rows(spark, texts), queries.vocabulary("byte_bpe_50k.json"), name="n")
    assert out.columns == ["doc_id", "text", "row", "text2", "n"]
    want = counts(byte_bpe[1], [t or "" for t in texts])
    assert sorted(r.n for r in out.collect()) == sorted([*want, want[-1]])
    empty = token_counts.count_tokens(odd_rows(spark, texts).limit(0), queries.vocabulary("byte_bpe_50k.json"))
    assert empty.collect() == []


def test_token_count_query(spark, byte_bpe):
    out = {r.doc_id: r for r in queries.QUERIES["op9_token_counts"](spark, SF_DIR).collect()}
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    for r, n in zip(rows, counts(byte_bpe[1], [r.text or "" for r in rows]), strict=True):
        assert (out[r.doc_id].n_tokens, out[r.doc_id].n_bytes) == (n, len((r.text or "").encode()))
        assert out[r.doc_id].over_limit == (n > 512)


# --- languages ------------------------------------------------------------------------------------------------------


def test_bloom_filters_have_no_false_misses():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 2**63, 3000).astype(np.uint64)
    number = rng.integers(0, 20, 3000)
    filters = language.build([f"l{i}" for i in range(20)], hashes, number, language.Settings())
    masks = filters.bits[language._slots(hashes, 0, len(filters.bits))]
    for i in range(1, filters.hashes):
        masks &= filters.bits[language._slots(hashes, i, len(filters.bits))]
    assert (masks[np.arange(3000), number // 8] >> (number % 8) & 1).all()
    assert (filters.false_hits < 0.05).all()


def test_grams_stay_inside_their_text():
    [(hashes, owner, letters)] = language.grams(["ab", "", "12", "ab  cd"], [3])
    assert letters.tolist() == [0, 3]
    assert np.bincount(owner, minlength=4).tolist() == [2, 0, 0, 5]
    assert hashes[owner == 0].tolist() == hashes[owner == 3][:2].tolist()


def plain_grams(text, sizes):
    letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    words = re.sub(" +", " ", letters)
    return [words[i : i + n] for n in sizes for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("piece", [1, 7, 50, 1 << 19])
def test_pieces_of_a_text_have_its_grams(piece):
    rng = random.Random(4)
    texts = ["".join(rng.choices("aBé中ß  1.\n", k=rng.randint(0, 120))) for _ in range(60)] + ["", "1", "x" * 300, " a" * 99]
    sizes = (1, 3, 4)
    found, letters = [Counter() for _ in texts], set()
    for hashes, owner, lettered in language.grams(texts, sizes, piece):
        letters.update(lettered.tolist())
        for h, i in zip(hashes.tolist(), owner.tolist(), strict=True):
            found[i][h] += 1
    name = {}
    for i, text in enumerate(texts):
        want = Counter(plain_grams(text, sizes))
        assert sorted(found[i].values()) == sorted(want.values())
        [(hashes, _, _)] = language.grams([text], sizes)
        for h, gram in zip(hashes.tolist(), plain_grams(text, sizes), strict=True):
            assert name.setdefault(h, gram) == gram  # in the same order, so hashes stand for n-grams
        assert found[i] == Counter(hashes.tolist()) and (i in letters) == any(c.isalpha() for c in text)


def test_languages_equal_those_of_plain_sets():
    rng = random.Random(9)
    vocabularies = {lang: ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(200)] for lang, letters in (("a", "abcdefgh"), ("b", "efghijkl"), ("c", "ijklmnop"))}
    texts = [" ".join(rng.choices(vocabularies[lang], k=30)) for lang in "abc" for _ in range(20)]
    sets = {lang: {g for w in words for g in plain_grams(w, (3, 4))} for lang, words in vocabularies.items()}
    coded = {lang: np.unique(np.concatenate([h for h, _, _ in language.grams(words, (3, 4))])) for lang, words in vocabularies.items()}
    filters = language.build(
        list(sets), np.concatenate(list(coded.values())), np.repeat(np.arange(3), [len(c) for c in coded.values()]), language.Settings()
    )
    names, scores = language.identify(texts, filters)
    for text, name, score in zip(texts, names, scores, strict=True):
        hits = {lang: sum(g in own for g in plain_grams(text, (3, 4))) for lang, own in sets.items()}
        assert name == max(hits, key=hits.get) and abs(score - hits[name] / sum(hits.values())) < 0.02


def test_a_very_long_text_takes_bounded_memory():
    filters = language.build(["a"], np.arange(1000, dtype=np.uint64), np.zeros(1000, np.int64), language.Settings())
    text = "some words of a text " * 600_000
    language.identify(["warm up"], filters)
    tracemalloc.start()
    names, _ = language.identify([text, "x"], filters)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert names == ["a", "a"] and peak < 150_000_000


@pytest.mark.parametrize("same", ["null", "equal"])
def test_languages_are_learned_whatever_the_ids(spark, same):
    words = {"en": "the cat sat on that mat ", "de": "der hund und die katze "}
    rows = [(None if same == "null" else 3, t * 5 + "x" * (i % 50), lang) for i in range(1000) for lang, t in words.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language.fit(docs, language.Settings(docs=100))
    assert language.identify(list(words.values()), filters)[0] == ["en", "de"]


def test_languages_are_learned_from_text_and_label_alone(spark):
    rows = [(i, t * 5, lang) for i, (t, lang) in enumerate([("the cat sat on that mat ", "en"), ("der hund und die katze ", "de")] * 10)]
    docs = spark.createDataFrame([*rows, (90, None, "en"), (91, "the und", None)], "doc_id long, text string, lang string")
    filters = language.fit(docs, language.Settings(least_count=1))
    assert set(filters.languages) == {"en", "de"}
    asked = odd_rows(spark, [None, "", "123 !?", "that cat", "und der hund", "ж"])
    got = {r.text: (r.lang_pred, r.score) for r in language.detect(asked, filters).collect()}
    assert got["that cat"][0] == "en" and got["und der hund"][0] == "de"
    assert got[None] == got[""] == got["123 !?"] == ("und", 0.0)
    assert got["ж"] == (filters.languages[0], 0.0)
    assert language.detect(asked.limit(0), filters).count() == 0
    nothing = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.detect(asked, nothing).collect()} == {"und"}


def test_language_query_is_right_on_held_out_documents(spark):
    out = queries.QUERIES["op2_language_filters"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").where("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


# --- personal data --------------------------------------------------------------------------------------------------


def plain_base(text):
    """The base patterns as they are written."""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        found += [("ip", *m.span())] if all(int(x) <= 255 for x in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(digits[::-1]))
        found += [("card", *m.span())] if 16 <= len(digits) <= 19 and total % 10 == 0 else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        found += [("phone", *m.span())] if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15 else []
    return found


def test_base_spans_equal_the_plain_patterns():
    parts = [*"ab1234 0.@-+()%_", "@a.b", "1.2.3.4", "4041894974608795", "+1 (988) 555-2485", "é", ".com", "🙂"]
    rng = random.Random(5)
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_base(text), text


@pytest.mark.parametrize("text", ["1" * 10**5, "a" * 10**5, "a@" * 10**5, "1." * 10**5, "+1" * 10**5, "mr " * 30_000])
def test_long_runs_take_linear_time(text):
    assert isinstance(pii.find(text, pii.fit_patterns([])), tuple)


def test_a_text_of_very_many_spans_takes_linear_time():
    model = pii.Model({"secret": np.append(np.zeros(len(pii.FEATURES)), 5.0)}, {})
    seconds = []
    for n in (5_000, 50_000):
        text = "".join(f"mail a{i}@example.org key abc123def456ghi{i}\n" for i in range(n))
        began = time.perf_counter()
        base, further = pii.find(text, model)
        seconds.append(time.perf_counter() - began)
        assert len(base) >= n and len(further) >= n * 0.9
    assert seconds[1] < 40 * seconds[0]


def test_further_spans_overlap_nothing():
    rng = random.Random(12)
    model = pii.Model({k: np.append(np.zeros(len(pii.FEATURES)), 5.0) for k in pii.FURTHER_KINDS}, {})
    parts = ["key=abc123def456ghi7", "a@b.co", " ", "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00", "Mr Ab Cd", "12 Long Street", "+49 170 1234567", "-"]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=rng.randint(1, 12)))
        base, further = pii.find(text, model)
        taken, want = list(base), []
        for c in pii.candidates(text):
            if all(c.end <= s or e <= c.start for _, s, e in taken):
                taken.append((c.kind, c.start, c.end))
                want.append((c.kind, c.start, c.end))
        assert further == want


def test_reliabilities_follow_the_better_labelers():
    rng = np.random.default_rng(6)
    truth = rng.random(4000) < 0.5
    votes = np.stack([np.where(rng.random(4000) < p, truth, ~truth) * 2 - 1 for p in (0.95, 0.9, 0.6)], axis=1)
    patterns, place = np.unique(votes, axis=0, return_inverse=True)
    likely, reliable = pii.likelihoods(patterns.astype(float), np.bincount(place.ravel()).astype(float))
    assert abs(reliable[0] - 0.95) < 0.03 and abs(reliable[1] - 0.9) < 0.03 and abs(reliable[2] - 0.6) < 0.06
    assert np.mean((likely[place.ravel()] > 0.5) == truth) > 0.93


def test_further_spans_are_found_and_replaced(spark):
    secret = 'set token = "8824c3a463b8b0d68516db48c461547d5799bf8b" now'
    plain = "see img/2024-photo-of-2-cats1.png or v1/abc-def-2-ghi and mail bosbt.42@mail8.example.com today"
    docs = odd_rows(spark, [None, "", *[secret] * 6, *[plain] * 6])
    model = pii.fit(docs)
    out = pii.detect(docs, model, redact=True)
    got = {(r.text, pii_spans(r)) for r in out.collect()}
    assert ('set token = "<SECRET>" now', "secret:13:53") in got
    assert any(t and "<EMAIL>" in t and "cats1" in t for t, _ in got)
    assert (None, "") in got and ("", "") in got and out.columns == [*docs.columns, "pii"]
    assert pii.detect(docs.limit(0), pii.fit(docs.limit(0))).count() == 0


def pii_spans(row):
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in [*row.pii.base, *row.pii.further])


def test_personal_data_query(spark):
    out = {r.doc_id: r for r in queries.QUERIES["op3_weak_supervision_pii"](spark, SF_DIR).collect()}
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        base = plain_base(r.text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        row = out[r.doc_id]
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
        assert set(joined.split(",")) - {""} <= set(row.spans.split(","))


def test_overlapping_spans_are_replaced_as_one():
    assert pii.redacted("abcdef", [("email", 1, 3), ("ip", 2, 5)]) == "a<EMAIL>f"


# --- toxicity -------------------------------------------------------------------------------------------------------


def toxic_samples(n=400):
    rng = random.Random(7)
    words = ["".join(rng.choice("aeinrstlmo") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    out = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        if i % 4 == 0:
            text[rng.randrange(len(text))] = rng.choice(["idiotic", "worthless", "disgusting"])
        out.append((" ".join(text), int(i % 4 == 0)))
    return out


def test_toxic_words_count_in_long_texts_and_misspelled():
    settings = toxicity.Settings(buckets=1 << 14)
    scorer = toxicity.Scorer(*toxicity.train(toxic_samples(), settings), settings)
    clean = " ".join(t for t, y in toxic_samples() if not y)
    assert scorer(clean) < 0.7 <= scorer(clean + " worthless " + clean)
    assert scorer("disgustingg worthles") > 0.7
    assert 0 <= scorer("") <= 1


@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=90), min_size=1, max_size=8), st.integers(1, 4))
def test_subwords_of_many_words_are_those_of_each(words, shortest):
    settings = toxicity.Settings(shortest=shortest, longest=shortest + 3, buckets=1 << 24)
    words += ["", "a", "aaaaaaaa", "ünïcödé", "漢字かな", "𝒳𝒴𝒵𝒳𝒴𝒵𝒳"]
    sizes, grams = toxicity.bags(words, settings)
    parts = np.split(grams, np.cumsum(sizes)[:-1])
    assert [sorted(p.tolist()) for p in parts] == [sorted(toxicity.subwords(w, settings)) for w in words]


def test_rare_labels_are_drawn_and_learned(spark):
    """Toxic rows are 1 in 5,000, and the sample is a small part of all rows."""
    settings = toxicity.Settings(max_docs=1_000, buckets=1 << 14)
    words = F.array(*(F.lit(w) for w in "a stone lies near the old river and nobody ever asks why it does".split()))
    plain = F.concat_ws(" ", F.shuffle(words, 3))
    toxic = F.col("id") % 5_000 == 77
    docs = spark.range(100_000).withColumn("label", toxic.cast("int")).withColumnRenamed("id", "doc_id")
    docs = docs.select("doc_id", "label", F.concat_ws(" ", plain, F.when(F.col("label") == 1, "worthless")).alias("text"))
    drawn = toxicity.sample(docs, docs, settings, key="doc_id", text="text", label="label")
    assert sum(y for _, y in drawn) == 20 and 800 < len(drawn) < 1_200
    scorer = toxicity.Scorer(*toxicity.train(drawn, settings), settings)
    assert scorer("the old river is worthless") >= 0.7 > scorer("the old river lies near a stone")
    few = toxicity.Settings(max_docs=100)
    many = docs.withColumn("label", F.col("doc_id").cast("int") % 2)
    assert 50 < len(toxicity.sample(many, many, few, key="doc_id", text="text", label="label")) < 150
    short = toxicity.Settings(max_chars=20_000)
    assert 10_000 < sum(len(x) for x, _ in toxicity.sample(many, many, short, key="doc_id", text="text", label="label")) < 30_000


@pytest.mark.parametrize("joint", ["_", ""])
def test_the_middle_of_a_long_run_is_read(joint):
    settings = toxicity.Settings(buckets=1 << 14)
    scorer = toxicity.Scorer(*toxicity.train(toxic_samples(), settings), settings)
    clean = " ".join(t for t, y in toxic_samples() if not y).split()[:200]
    run = joint.join([*clean, "worthless", "disgusting", *clean])
    assert scorer(joint.join(clean)) < 0.7 <= scorer(run)
    assert scorer(run.replace("worthlessdisgusting", "x")) < 0.7 or joint


def test_texts_of_one_id_are_drawn_one_by_one(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(3000)] + [(2, "same")] * 2000, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    drawn = toxicity.sample(docs, labels, toxicity.Settings(max_docs=200), key="doc_id", text="text", label="toxic")
    assert 120 < len(drawn) < 300 and {y for _, y in drawn} == {0, 1}
    assert sum(t == "same" for t, _ in drawn) <= 1


def test_toxic_documents_that_were_held_back_are_found(spark):
    sf = "/root/testdata/sf0.01"
    scored = {r.doc_id: r for r in queries.QUERIES["op4_toxicity"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").collect()
    held = [(scored[r.doc_id].predicted, r.toxic) for r in labels if r.doc_id in scored and scored[r.doc_id].held_out]
    found = [p for p, y in held if y == 1]
    clean = [p for p, y in held if y == 0]
    # 33 toxic texts to learn from; two of the 18 asked hold repeated junk and no word that tells them from clean ones
    assert sum(found) >= 14 and len(found) == 18 and sum(clean) <= 0.02 * len(clean)


def test_one_class_or_none():
    assert toxicity.train([])[1] == 0.0
    assert toxicity.train([("a", 1)])[1] > 0 > toxicity.train([("a", 0), (None, 0)])[1]


def test_scores_of_odd_rows(spark):
    settings = toxicity.Settings(buckets=1 << 10)
    docs = odd_rows(spark, [None, "", "!!", "worthless " * 3000])
    out = toxicity.score(docs, np.zeros(1 << 10), -1.0, settings, name="ROW")
    assert out.columns == ["doc_id", "text", "text2", "n", "ROW"] and out.count() == 5
    assert {round(r.ROW, 6) for r in out.collect()} == {round(1 / (1 + np.exp(1)), 6)}
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 7)], "doc_id long, toxic int")
    drawn = toxicity.sample(docs, labels, settings, key="doc_id", text="text", label="toxic")
    assert sorted(drawn) == [("", 0), ("", 1)]
    assert toxicity.sample(docs.limit(0), labels.limit(0), settings, key="doc_id", text="text", label="toxic") == []


def test_toxicity_query(spark):
    out = queries.QUERIES["op4_toxicity"](spark, SF_DIR).collect()
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)


# --- pages ----------------------------------------------------------------------------------------------------------

ARTICLE = "<h1>Title &amp; more</h1><p>First   <b>bold</b>\n text with some words in it.<p>Second&nbsp;one<br>goes on, too."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>x</title></head><body><nav><a href=/>menu</a></nav><article>{ARTICLE}</article><footer>f</footer>",
        f"<body><div class='top-bar nav'>Menu words here</div><div id=content><div class='post-body'>{ARTICLE}"
        "<div class='share-buttons'>Tweet this</div><section id=comments><p>I am a comment, long enough to look like text."
        "</section></div></div><div class=sidebar><p>Other text of the sidebar with enough words to look like prose.</div>",
        f"<main><header class=hero><h2></h2><p>by someone</p></header>{ARTICLE}<script>var a='<p>no</p>'</script>"
        "<form><p>Subscribe now</p><input></form><ol class=commentlist><li>A reader says this.</ol><p hidden>not shown</p></main><!-- <p>hidden</p> --><aside><p>aside text</p></aside>",
    ],
)
def test_main_text_of_templates(page):
    path = html_text.best_path(page)
    assert html_text.main_text(page, {path: 1.0}) == "Title & more\nFirst bold text with some words in it.\nSecond one goes on, too."


PROSE = "A sentence of the article that is long enough to read like prose, with some more words."


@pytest.mark.parametrize(
    "page",
    [
        f"<article><h2 id='related-work'>Title</h2><p id='social-effects'>{PROSE}<section id='discussion'><p>End {PROSE}</section></article>",
        f"<article><h2>Title</h2><p>{PROSE}<div class=commentary><p>End {PROSE}</div><div class=comments><p>{PROSE}</div></article>",
        f"<div class='content-sidebar-wrap'><main><article><h2>Title</h2><p>{PROSE}<p>End {PROSE}</article></main><div class=sidebar>x</div></div>",
        f"<div class='layout-sidebar-right'><article><h2>Title</h2><p>{PROSE}<p>End {PROSE}</article><div class=sidebar>x</div></div>",
        f"<div class='page-header-wrap'><h2>Title</h2><p>{PROSE}<p>End {PROSE}</div>",
        f"<div class=doc><h2>Title</h2><p>{PROSE}<div id=related-work><p>End {PROSE}</div></div>".replace("<p>End", "<h3>Related work</h3><p>End"),
        f"<div class=comment-list><h2>Title</h2><p>{PROSE}<p>End {PROSE}</div>",
    ],
)
def test_words_of_classes_and_ids_lose_no_article(page):
    want = ["Title", PROSE, f"End {PROSE}"]
    text = html_text.main_text(page, {html_text.best_path(page): 1.0})
    assert [line for line in text.split("\n") if line != "Related work"] == want


def test_formulas_are_text():
    page = "<p>where <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding=tex>x = 2</annotation></math> holds"
    assert html_text.main_text(page, {"body": 1.0}) == "where x=2 holds"


@pytest.mark.parametrize("page", ["<annotation>" * 20_000, "<div class=nav>" * 190 + "<p>a" * 5_000, "<" * 50_000, '<a href="x' * 5_000, "<div>" * 5_000 + "deep", "<p>a" * 20_000, "<b" * 9_000])
def test_broken_pages_take_linear_time(page):
    html_text.main_text(page, {})


def test_tables_and_deep_pages():
    assert html_text.main_text("<table><tr><td>cell one<td>cell two<tr><td>x</table>", {"body": 1.0}) == "cell one\ncell two\nx"
    deep = html_text.main_text("<div>" * 300 + "<p>deep text</p>" + "</div>" * 300 + "<p>after</p>", {"body": 1.0})
    assert deep == "deep text\nafter"


def test_pages_of_a_host_follow_its_template(spark):
    rows = [(i, f"https://Host.example:8{i}/a?b", f"<div class=c{i}><p>{'word ' * 40}</div><div class=x>odd</div>") for i in range(9)]
    short = "<div class=c99><p>short</div><div class=x>" + "advert without a name " * 20 + "</div>"
    rows += [(9, "//host.example/z", short), (10, None, ""), (11, "no address", None), (12, "http://b.example", "plain")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumns({"row": F.lit(1), "text": F.lit("old"), "paths": F.lit(2)})
    out = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert out[0] == ("word " * 40).strip() and out[9] == "short" and out[10] == out[11] == "" and out[12] == "plain"
    assert html_text.extract(pages.limit(0)).count() == 0


def test_page_query_gives_the_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in queries.QUERIES["op8_host_consensus"](spark, SF_DIR).collect():
        article = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [re.sub("<[^>]*>", "", b).replace("&amp;", "&") for b in re.split(r"</?(?:p|h1)>", article)]
        want = [" ".join(b.split()) for b in blocks]
        if "&" not in article.replace("&amp;", ""):
            assert r.text == "\n".join(b for b in want if b)
        assert r.n_chars == len(r.text)
