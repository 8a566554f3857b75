"""The training-data operators against brute force, round trips, oracles and edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dqforge.llm import chat_format, common, components, decontam, exact_dedup, langid, ngram_join, packing, quality, secret_scan, toxicity, url_filter
from dqforge.llm.queries import ORACLE_SQL, QUERIES
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, token string, h1 string"
#: nulls in every column, empty texts, a very long text, ties and repeated rows, clashing extra columns
ODD = [(1, "a b c d e f g h", "en", "s", 8, "r", "t", "x"), (2, "a b c d e f g h", "en", "s", 8, None, "t", "x"), (2, "a b c d e f g h", "en", "s", 8, None, "t", "x"),
       (3, "", None, None, None, None, None, None), (4, None, None, None, None, None, None, None), (None, "a b c", "de", "s", 5, "r", "t", "x"),
       (None, None, None, None, None, None, None, None), (5, "word " * 60_000, "en", "s", 9, "r", "t", "x"), (6, "A B c D e f g h", "fr", "s", 8, "r", "t", "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def docs(spark, name="documents"):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracles(spark, name):
    r = compare(QUERIES[name](spark, SF), duck(SF), ORACLE_SQL[name])
    assert r["schema_match"] and r["count_match"] and r["value_match"], r


# ------------------------------------------------------------------------------------------ 1

def test_exact_dedup_collisions(spark):
    rows = [(i, t) for i, t in enumerate(["aa", "bb", "aa", None, "", "cc", "bb"])] + [(0, "aa")]
    weak = lambda text: [F.length(text).cast("long"), F.lit(1).cast("long")]  # noqa: E731  every two-letter text collides
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.duplicates(df, "max", weak).collect())
    want = sorted([(0, 2, 3, False), (0, 2, 3, False), (2, 2, 3, True), (1, 6, 2, False), (6, 6, 2, True), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True)])
    assert got == want


def test_exact_dedup_odd(odd, empty):
    got = exact_dedup.duplicates(odd).collect()
    assert len(got) == len(ODD) and sum(r.kept for r in got) == len({r[1] or "" for r in ODD})
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "5", "6", "None"]
    assert exact_dedup.duplicates(empty).count() == exact_dedup.deduplicate(empty).count() == 0


# ------------------------------------------------------------------------------------------ 2

def brute_components(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    up, lists = {d: d for d in sets}, defaultdict(list)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for d, s in sets.items():
        common = Counter(e for x in s for e in lists[x])
        for x in s:
            lists[x].append(d)
        for e, k in common.items():
            if 100 * k >= 75 * (len(s) + len(sets[e]) - k):
                a, b = sorted((root(d), root(e)))
                up[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def near_copies():
    """A large group of near copies, a line that many documents share, and small groups."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    base, line = list(rng.choice(words, 90)), list(rng.choice(words, 12))
    rows = []
    for i in range(120):
        t = list(base)
        for at in rng.choice(90, rng.integers(0, 5), replace=False):
            t[at] = str(rng.choice(words))
        rows.append((i, " ".join(t)))
    rows += [(200 + i, " ".join(line + list(rng.choice(words, rng.integers(1, 30))))) for i in range(80)]
    rows += [(400 + i, " ".join(rng.choice(["x", "y"], rng.integers(0, 12)))) for i in range(40)]
    return rows


def test_ngram_join_brute_force(spark):
    rows = near_copies() + [(r.doc_id, r.text) for r in docs(spark).select("doc_id", F.col("text")).limit(60).collect() if r.doc_id > 1000]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_ngram_join_all_links(spark):
    rows = near_copies()
    rows += [(1000 + i, t) for i, (_, t) in enumerate(rows[:30])] + [(2000, None)]
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    linked = lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)
    want = {d: (len(s), sum(linked(s, t) for e, t in sets.items() if e != d)) for d, s in sets.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counts = ngram_join.link_counts(df).collect()
    assert {r.doc_id: (r.n_shingles, r.n_links) for r in counts} == want and max(n for _, n in want.values()) > 50


def test_ngram_join_odd(odd, empty):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.near_duplicates(odd).collect())
    assert got == sorted([("1", 4, "1"), ("2", 4, "1"), ("2", 4, "1"), ("6", 4, "1"), ("3", 0, "3"), ("4", 0, "4"), ("None", 1, "None"), ("None", 0, "None"), ("5", 1, "5")])
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "None", "None"]
    assert ngram_join.near_duplicates(empty).count() == 0 and ngram_join.keep_one(empty).count() == 0


def test_one_row_of_each_component_stays(spark):
    t = "a b c d e f g h i j k l m n o p q r s t"
    rows = [(1, t, "y"), (1, t, "x"), (7, t, "x"), (7, t + " u", "x"), (1, t + " u", "z"), (None, t, "x"), (2, "v w x y z 1", "a"), (2, "v w x y z 1", "a"),
            (None, "5 6 7 8 9 0", "a"), (None, "5 6 7 8 9 0", "b"), (None, None, "a"), (None, None, "a"), (3, "", "a"), (3, "", "a"), (1, "another text of seven words is here", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, class string").repartition(4)
    got = sorted((tuple(r) for r in ngram_join.keep_one(df).collect()), key=str)
    (stays,) = [r for r in got if r[0] == 1 and r[1].startswith("a b")]  # of the texts under id 1, the smallest row key
    assert stays in [(1, t, "x"), (1, t + " u", "z")]
    assert got == sorted([stays, (2, "v w x y z 1", "a"), (None, "5 6 7 8 9 0", "a"), (None, None, "a"), (None, None, "a"), (3, "", "a"), (3, "", "a"), rows[-1]], key=str)
    assert all(sorted((tuple(r) for r in ngram_join.keep_one(df.repartition(n)).collect()), key=str) == got for n in (1, 7))


def test_exact_dedup_ties_of_an_id(spark):
    rows = [(1, "t", "a", {"k": 1}), (1, "t", "b", None), (1, "t", None, {"k": 2}), (None, "t", "a", None), (2, "t", "a", None), (3, None, "a", None), (3, "", "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tie string, one map<string, int>")
    for keep, first in (("min", 1), ("max", 2)):
        got = {tuple((r.doc_id, r.text, r.tie) for r in sorted(exact_dedup.deduplicate(df.repartition(n), keep).collect(), key=lambda r: r.doc_id)) for n in (1, 2, 5)}
        assert len(got) == 1
        (kept,) = got
        assert [r[0] for r in kept] == [first, 3] and kept[1][1] == ""


def test_labelled_sample_is_bounded(spark):
    df = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(4, "other"), (4, None)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    got, counts = common.labelled_sample(df, labels, "toxic", 4, 9, 10)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "text 0", 1), (4, "", 0)] and counts == {0: 1, 1: 1}


def test_shingler_chunks_agree():
    text = "Ab c\td " * 400_000
    w = text.encode().lower().split()
    assert len(ngram_join.Shingler().hashes(text)) == len({tuple(w[i:i + 5]) for i in range(12)})


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 101), (7, 7), (200, 150), (200, 160)]
    got = {r.id: r.comp for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 150: 150, 160: 150, 200: 150}


# ------------------------------------------------------------------------------------------ 3, 5, 10

def auc(y, p):
    order = np.argsort(np.argsort(p, kind="stable"), kind="stable") + 1
    y = np.asarray(y, bool)
    return (order[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    # sf0.01 has some 40 toxic rows to learn from and 9 held out: 0.71 was measured for toxicity
    for name, label, least in (("op3_toxicity", "toxic", 0.7), ("op10_quality", "quality", 0.97)):
        rows = [r for r in QUERIES[name](spark, sf).collect() if r.held_out and r.doc_id in labels]
        assert auc([labels[r.doc_id][label] for r in rows], [r.score for r in rows]) >= least
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op5_language_id"](spark, sf).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert np.mean([r.lang_pred == want[r.doc_id] for r in rows]) >= 0.95


def test_subwords_reach_misspellings():
    bad, good = ["you are an idiot"] * 30, [f"the w{i} is fine today" for i in range(60)]
    model = toxicity.train(bad + good, [1] * 30 + [0] * 60, 1 / 3)
    assert model.scores(["such an idiott"])[0] > 0.5 > model.scores(["the day is fine"])[0]


def test_classifiers_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, None, 1), (5, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for op, fit in ((toxicity, toxicity.fit), (quality, quality.fit)):
        for l in (labels, labels.limit(0)):
            model = fit(odd, l)
            rows = op.score(odd, model).collect()
            assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
            assert op.score(empty, model).count() == 0
    for d in (odd, empty):
        got = {r.lang_pred for r in langid.identify(odd, langid.fit(d)).where("doc_id IN (3, 4)").collect()}
        assert got == {"und"}
    assert quality.keep_good(odd, quality.fit(odd, labels.limit(0)), 0.0).columns == odd.columns


def test_no_letter_is_no_language(spark):
    df = spark.createDataFrame([(1, "the cat sat here", "en"), (5, "die Katze saß", "de"), (6, "² ½ ③", None), (7, "Ⅳ 12 ___", None), (8, "1² é", None), (9, "字", None)],
                               "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(df, langid.fit(df, held=9)).collect()}
    assert got[6] == got[7] == "und" and "und" not in (got[1], got[5], got[8], got[9])
    for text in ("² ½ ③", "Ⅳ", "__", "", "a", "²b", "ª", "字"):
        assert langid.has_letter(text) == any(c.isalpha() for c in text)


def test_automaton():
    text = "abracadabra"
    step = langid.automaton(text)

    def occurs(s):
        state = 0
        for c in s:
            if (state := step[state].get(c)) is None:
                return False
        return True

    every = {text[i:j] for i in range(11) for j in range(i + 1, 12)}
    assert all(occurs(s) for s in every) and not any(occurs(s) for s in ("abc", "ba", "abrab") if s not in every)
    assert langid.phrases("abraxcad", step) == 3


def test_language_id_little_and_long_text(spark):
    rng = np.random.default_rng(2)
    vocab = {lang: ["".join(rng.choice(list(abc), rng.integers(3, 9))) for _ in range(300)] for lang, abc in (("aa", "abcdefghij"), ("bb", "efghijklmn"), ("cc", "ijklmnopqr"), ("dd", "mnopqrstuv"))}
    text = lambda lang, n: " ".join(rng.choice(vocab[lang], n))
    rows = [(i, lang, text(lang, 60)) for i, lang in enumerate(["aa", "bb"] * 150)]
    rows += [(1000, "cc", text("cc", 20_000)), (1001, "cc", text("cc", 20_000)), (2001, "ok", "ok"), (2002, "dd", text("dd", 250))]
    mine = {zlib.crc32(str(i).encode()) % 4 for i in (1000, 1001)}
    df = spark.createDataFrame([(i, lang, t) for i, lang, t in rows], "doc_id long, lang string, text string")
    model = langid.fit(df, held=next(k for k in range(4) if k not in mine | {zlib.crc32(str(i).encode()) % 4 for i in (2001, 2002)}))
    assert len(model.texts["cc"]) == langid.LEARN_CHARS and min(len(model.texts[k]) for k in ("aa", "bb")) > 40_000
    assert model.texts["ok"] == " ok " and len(model.texts["dd"]) < 2_500
    asked = [(lang, text(lang, 15)) for lang in vocab for _ in range(50)]
    assert [p for p, _ in model.predict([t for _, t in asked])] == [lang for lang, _ in asked]


# ------------------------------------------------------------------------------------------ 4

def test_chat_round_trip(spark):
    turns = [("user", "</s>[INST] ok [/INST]"), ("assistant", "\\l <s> [ROLE x] a\\"), ("we]ird\\r", "[INST"), ("", ""), ("assistant", "")]
    assert [t[:2] for t in chat_format.read_instruct(chat_format.instruct(turns))] == turns
    long = [(7, i, "user" if i % 2 == 0 else "assistant", f"text {i} [INST]") for i in range(60)]
    df = spark.createDataFrame(long + [(None, None, None, None), (None, 1, "assistant", "x")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.format_conversations(df).collect()}
    assert got[7].n_turns == 60 and not got[7].rewrites and got[7].formatted_chars == len(chat_format.instruct([(r, t) for _, _, r, t in long]))
    assert got[7].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in long).encode()).hexdigest()
    assert got[7].loss_sha256 == hashlib.sha256("".join(t for _, _, r, t in long if r == "assistant").encode()).hexdigest()
    assert got[None].n_turns == 2 and got[None].loss_chars == 1
    spans = chat_format.format_turns(df).where("conv_id = 7").orderBy("turn").collect()
    assert "".join(s.span for s in spans) == chat_format.instruct([(r, t) for _, _, r, t in long])
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_chat_rewriting_template(spark):
    def forgets(turns):  # drops thoughts of earlier turns once a new one comes
        return "".join(chat_format.instruct([(r, re.sub("<think>.*?</think>", "", t) if i + 1 < len(turns) else t)]) for i, (r, t) in enumerate(turns))

    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "<think>hm</think>b"), (1, 2, "user", "c"), (2, 0, "user", "a"), (2, 1, "assistant", "b")],
                               "conv_id long, turn long, role string, text string")
    assert {r.conv_id: r.rewrites for r in chat_format.format_conversations(df, forgets).collect()} == {1: True, 2: False}


def test_chat_every_prefix_is_rendered(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "PART", 7)  # several tasks a conversation

    def numbered(turns):  # a number before each turn
        return "".join(chat_format.instruct([(r, f"{i} {t}")]) for i, (r, t) in enumerate(turns))

    def last_20(turns):
        return chat_format.instruct(turns[-20:])

    rows = [(c, i, "user" if i % 2 == 0 else "assistant", f"text {i * c}") for c, n in ((1, 45), (2, 20), (3, 21)) for i in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for render, rewritten in ((numbered, set()), (last_20, {1, 3})):
        got = {r.conv_id: r for r in chat_format.format_conversations(df, render).collect()}
        spans = chat_format.format_turns(df, render).orderBy("conv_id", "turn").collect()
        for c in (1, 2, 3):
            turns, text = [(r, t) for k, _, r, t in rows if k == c], ""
            for i, s in enumerate(s for s in spans if s.conv_id == c):
                text = text[:s.span_start] + s.span
                assert text == render(turns[:i + 1]) and s.rewrites == (c in rewritten and i >= 20)
            read = chat_format.read_instruct(text)
            assert got[c].n_turns == len(turns) and got[c].formatted_chars == len(text) and got[c].rewrites == (c in rewritten)
            assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t, _, _ in read).encode()).hexdigest()


# ------------------------------------------------------------------------------------------ 6

def test_packing_is_whole(spark, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary("word_bpe_49k.json"))
    hard = ["İ, ﬁ, ÀÉ. word., a.b. !!, <|endoftext|> <|ENDOFTEXT|>", "x\x1cy\u2003z\r\nq\x85w\x00v ΑΣ Σ", "don't IT'S, 'S."]
    df = docs(spark).select("doc_id", "text").unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(hard)], "doc_id long, text string"))
    df = df.repartition(5, "doc_id")
    rows = packing.pack(df, with_ids=True).collect()
    mine, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        mine[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for r in df.collect():
        got = b"".join(bytes(p.ids) for p in sorted(mine[r.doc_id], key=lambda p: p.start))
        assert np.frombuffer(got, "<u4").tolist() == [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
    for pieces in windows.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    assert sum(sum(p.length for p in w) < 2048 for w in windows.values()) <= 1  # padding in one window at most
    assert sum(r.length for r in packing.pack(odd).where("doc_id = 4 OR doc_id = 3").collect()) == 2
    assert packing.pack(odd.limit(0)).count() == 0


# ------------------------------------------------------------------------------------------ 7

def test_secret_spans(spark, odd, empty):
    key = "q8Zr2Lx9Vb4Nt7Kp1Ws6Yd3"
    text = f"é token: secret: abcdefghijkl PASSWORD = '{'x1' * 7}' AKIA{'A1' * 8} {'0af3' * 8} {key} 123e4567-e89b-12d3-a456-426614174000 path/to/file-2024-01-02.txt"
    got = secret_scan.spans(text, secret_scan.TokenTest("byte_bpe_50k.tiktoken", 2.2))
    assert [(secret_scan.KINDS[k], text[a:b]) for a, k, b in got] == [
        ("assign", f"PASSWORD = '{'x1' * 7}"), ("access", f"AKIA{'A1' * 8}"), ("hex", "0af3" * 8), ("random", key)]
    rows = secret_scan.digest(secret_scan.scan(odd)).collect()
    assert len(rows) == len(ODD) and all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert secret_scan.scan(empty).count() == 0


def test_secrets_in_paths_and_of_letters():
    import string

    rng, test = np.random.default_rng(4), secret_scan.TokenTest("byte_bpe_50k.tiktoken", 2.2)
    draw = lambda abc: "".join(rng.choice(list(abc), 24))
    for abc in (string.ascii_letters + string.digits, string.ascii_letters):
        for before in ("", "www.example.org/articles/2024/information/", "hooks.example.com/services/workflow/incoming/notifications/", "0123456789abcdef_"):
            keys = [draw(abc) for _ in range(60)]
            got = [{b for _, k, b in secret_scan.spans(f"see {before}{key} now", test) if k == 3} for key in keys]
            assert sum(4 + len(before) + 24 in g for g in got) >= 57, (abc, before)
    for plain in ("www.example.org/articles/2024/information/index.html", "internationalization-of-the-documentation", "INTERNATIONAL_STANDARD_2024", "2024-01-02/12345678901/3",
                  "getElementsByClassName", "123e4567-e89b-12d3-a456-426614174000"):
        assert not secret_scan.spans(plain, test)


# ------------------------------------------------------------------------------------------ 8

def test_url_rules(spark):
    rules = spark.createDataFrame([("block", "Ex.org", "/a"), ("allow", "ex.org", "/ab"), ("block", "b.ex.org", ""), (None, "x", "/"), ("block", None, "/")], "verdict string, host string, path string")
    urls = ["http://EX.org/ab?x", "http://ex.org/ac", "http://b.ex.org", "http://bex.org/ab", "nothing", None, "", "http://b.ex.org/abc#/d", "a://c.b.ex.org://x"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, rules).collect()}
    assert got == {0: ("ex.org", "/ab", "ex.org/ab", "allow"), 1: ("ex.org", "/ac", "ex.org/a", "block"), 2: ("b.ex.org", "", "b.ex.org", "block"),
                   3: ("bex.org", "/ab", None, "allow"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
                   7: ("b.ex.org", "/abc", "ex.org/ab", "allow"), 8: ("c.b.ex.org:", "//x", None, "allow")}
    assert url_filter.judge(df, rules.limit(0)).where("verdict = 'allow'").count() == len(urls)
    assert url_filter.judge(df.limit(0), rules).count() == 0


def test_urls_of_many_labels_and_odd_rows(spark):
    rules = spark.createDataFrame([("block", "b.c.d.org", "/"), ("allow", "org", "/p"), ("block", "", "/q"), ("block", "org", "/p")], "verdict string, host string, path string")
    deep, path = "a." * 40_000 + "b.c.d.org", "/p" + "x" * 200_000
    urls = [f"h://{deep}/z", f"h://{deep}{path}", "h://d.org/p", "h://org./q", "h://xb.c.d.org/", "h://B.C.D.ORG/", "h://./q", "h:///q", None, "h://d.org/p"]
    df = spark.createDataFrame([(i, u, "h", "p", "r", "v") for i, u in enumerate(urls)] + [(2, urls[2], None, None, None, None)],
                               "page_id long, url string, host string, path string, rule string, verdict string").repartition(3)
    got = sorted((r.page_id, r.rule, r.verdict) for r in url_filter.judge(df, rules).fillna("").collect())
    assert got == sorted([(0, "b.c.d.org/", "block"), (1, "b.c.d.org/", "block"), (2, "org/p", "block"), (2, "org/p", "block"), (3, "/q", "block"), (4, "", "allow"),
                          (5, "b.c.d.org/", "block"), (6, "/q", "block"), (7, "", "allow"), (8, "", "allow"), (9, "org/p", "block")])


# ------------------------------------------------------------------------------------------ 9

def brute_leaks(texts, items, similarity=0.75):
    words = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    bag = lambda w: Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    out = set()
    for k, item in items:
        iw = words(item)
        ib = bag(iw)
        for d, text in texts:
            w = words(text)
            for at in range(max(1, len(w) - len(iw) + 1)) if w and iw else ():
                wb = bag(w[at:at + len(iw)])
                if sum((wb & ib).values()) >= similarity * sum((wb | ib).values()):
                    out.add((d, k))
                    break
    return out


def test_decontamination_brute_force(spark, odd, empty):
    rng = np.random.default_rng(5)
    items = [(r.item_id, r.text) for r in docs(spark, "benchmark").limit(12).collect()]
    texts = [(r.doc_id, r.text) for r in docs(spark).limit(40).collect()]
    for k, t in items:
        w = t.split()
        texts.append((5000 + k, " ".join(["some", "words", "before", *w, "and", "after"])))
        edited = list(w)
        edited[len(w) // 2] = "zzz"
        texts.append((6000 + k, " ".join([*rng.permutation(w), *edited, "x"])))
        texts.append((7000 + k, " ".join(w[:int(len(w) * 0.9)])))
    items += [(900, items[0][1]), (901, ""), (902, None), (903, "!!")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()}
    assert got == brute_leaks(texts, items)
    left = decontam.clean(df, bench)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in texts} - {d for d, _ in got}
    assert decontam.contaminated(odd, bench).count() == 0 and decontam.contaminated(empty, bench).count() == 0
    assert decontam.contaminated(df, bench.limit(0)).count() == 0


def test_decontamination_cuts_at_the_limit(spark):
    rng = np.random.default_rng(8)
    items = [(k, " ".join(f"v{x}" for x in rng.choice(5000, 16 + k % 44, replace=False))) for k in range(150)]
    texts = []
    for k, t in items:  # as many words of an end replaced as the similarity allows
        w = t.split()
        n = decontam.lost(len(w) - 4, 0.75)
        texts += [(2 * k, " ".join([*w[:len(w) - n], *[f"z{i}" for i in range(n)]])), (2 * k + 1, " ".join([*[f"z{i}" for i in range(n)], *w[n:]]))]
    df, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {x for k in range(150) for x in brute_leaks(texts[2 * k:2 * k + 2], items[k:k + 1])}
    assert len(want) == 300 and {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()} == want


def test_fingerprints_within_the_radius(spark):
    rng = np.random.default_rng(4)
    items = [(k, 5 + k % 2, int(b)) for k, b in enumerate(rng.integers(-2**63, 2**63, 6))]
    items += [(6, 5, -1), (7, 5, 0)]
    rows = []
    for k, n, b in items:
        for far in range(0, 40):
            mask = sum(1 << int(i) for i in rng.choice(64, far, replace=False))
            rows.append((len(rows), n, int(np.array((b ^ mask) & (2**64 - 1), np.uint64).view(np.int64))))
    prints, of = spark.createDataFrame(rows, "row long, n int, bits long"), spark.createDataFrame(items, "item long, n int, bits long")
    for radius in (0, 1, 7, decontam.RADIUS):
        cuts = decontam.blocks(radius)
        assert sum(w for _, w, _ in cuts) == 64 and sum(t + 1 for _, _, t in cuts) == radius + 1
        want = sorted((r, k) for r, n, b in rows for k, m, c in items if n == m and ((b ^ c) & (2**64 - 1)).bit_count() <= radius)
        got = sorted((r.row, r.item) for r in decontam.within(prints, of, radius).collect())
        assert got == want and len(want) >= 8 * (radius + 1)


def test_decontamination_radius_decides(spark):
    item = " ".join(f"v{x}" for x in range(30))
    edited = " ".join([f"v{x}" for x in range(28)] + ["y", "z"])
    df = spark.createDataFrame([(1, item), (2, edited)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    found = lambda **k: {r.doc_id for r in decontam.contaminated(df, bench, **k).collect()}
    assert found() == {1, 2} and found(radius=0) == {1}


def test_decontamination_recall_on_edited_items(spark):
    """Against brute force: items cut at both ends, with words replaced, put in or left out."""
    rng = np.random.default_rng(11)
    items = [(k, " ".join(f"v{x}" for x in rng.choice(400, 14 + k % 46))) for k in range(120)]
    items.append((500, " ".join(f"u{x}" for x in range(700))))
    texts = []
    for k, t in items:
        w = t.split()
        n = decontam.lost(len(w) - 4, 0.75)
        at = int(rng.integers(1, len(w) - 1))
        for kind in ([*w[n // 2:len(w) - (n - n // 2)]], [*w[:at], "zz", *w[at + 1:]], [*w[:at], "zz", *w[at:]], [*w[:at], *w[at + 1:]], ["q1", "q2", *w[n:], "q3"]):
            texts.append((len(texts), " ".join(kind)))
    df, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {x for k in range(len(items)) for x in brute_leaks(texts[5 * k:5 * k + 5], items[k:k + 1])}
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()}
    assert len(want) > 300 and len(got & want) >= 0.99 * len(want)
    own = {(r, k) for r, k in got if r // 5 == [i for i, _ in items].index(k)}
    assert own <= want


def test_decontamination_short_items(spark):
    items = [(1, "Xylophone"), (2, "one two three"), (3, "a b c d"), (4, "a b c d e"), (5, "absent")]
    texts = [(1, "long before the xylophone and words after it"), (2, "so one two, three is counted here"), (3, "a b c d e f"), (4, "one two"), (5, "xylophone"),
             (6, "one two tree three four five"), (7, "a b c d")]
    df, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()}
    assert got == brute_leaks(texts, items) == {(1, 1), (5, 1), (2, 2), (3, 3), (7, 3), (3, 4)}


def test_no_python_in_native_plans(spark):
    for name in ("op8_url_filter", "op9_decontamination"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# ------------------------------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark):
    frame = docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in frame.collect()}
        frame = stage(spark, frame, SF)
        frame = spark.createDataFrame(frame.collect(), frame.schema)
        after = {r.doc_id: r.text for r in frame.collect()}
        assert frame.columns == docs(spark).columns and after.items() <= before.items()
        if name == "exact dedup":
            assert len(set(after.values())) == len(after) == len(set(before.values()))
        if name == "n-gram Jaccard join":
            assert set(after) == {d for d, (n, c) in brute_components(before.items()).items() if c == d}
        if name == "benchmark decontamination":
            items = [(r.item_id, r.text) for r in docs(spark, "benchmark").collect()]
            assert set(after) == set(before) - {d for d, _ in brute_leaks(before.items(), items)}
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in frame.collect()}
