import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from despensa.llm import langid, pii, toxicity, wrappers

WORDS = {"en": "the of and to in that with from which there".split(),
         "fr": "le la les une dans pour avec été très où".split(),
         "ru": "и в не на что как это из все они".split()}


@pytest.fixture(scope="module")
def tongues(docs_of):
    rng = random.Random(1)
    rows, n = [], 0
    for lang, words in WORDS.items():
        for _ in range(60):
            rows.append((n, " ".join(rng.choice(words) for _ in range(rng.randint(5, 60))), lang))
            n += 1
    return rows


def test_language_held_out(docs_of, tongues):
    learn = [r for r in tongues if r[0] % 4]
    model = langid.fit(docs_of(learn), clusters=3)
    assert model.languages == sorted(WORDS) and len(model.centroids) == 9
    got = langid.predict(docs_of(tongues), model)
    right = got.filter("lang_pred = lang").count()
    assert right >= 0.97 * len(tongues)
    assert got.filter("score < 0 OR score > 1").count() == 0
    assert got.filter("rejected").count() <= 0.03 * len(tongues)


def test_language_rejects_what_lies_far(docs_of, tongues):
    model = langid.fit(docs_of(tongues))
    odd = docs_of([(1, "qzx jkw vbq " * 30), (2, None), (3, ""), (4, "12 34 !!"), (5, "the of and to in that")])
    got = {r["doc_id"]: r for r in langid.predict(odd, model).collect()}
    assert got[1]["rejected"] and not got[5]["rejected"] and got[5]["lang_pred"] == "en"
    for i in (2, 3, 4):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)


def test_language_odd_rows(docs_of, odd_rows, tongues):
    docs = docs_of(odd_rows)
    got = langid.predict(docs, langid.fit(docs_of(tongues)))
    assert got.count() == len(odd_rows)
    assert Counter(got.columns) == Counter([*docs.columns, "lang_pred", "rejected"])  # score replaced
    kept = langid.keep_known(docs_of(tongues + [(900, "??", "en"), (901, None, None)]))
    assert kept.columns == docs.columns and kept.filter("doc_id >= 900").count() == 0
    nothing = docs_of([(1, "abc", None), (2, None, "en")])
    assert langid.fit(nothing) is None
    assert [r["lang_pred"] for r in langid.predict(nothing, None).collect()] == ["und", "und"]
    assert langid.predict(docs_of([]), None).count() == 0


def test_language_keeps_clean_texts_of_any_length(docs_of):
    rng = random.Random(5)
    words = ["".join(rng.choice("aeinorst" if i < 300 else "abcdefghijklmnopqrstuvwxyz")
                     for _ in range(rng.randint(2, 8))) for i in range(20_000)]
    odds = np.cumsum([1 / (i + 3) ** 1.1 for i in range(len(words))]).tolist()

    def text(n):
        return " ".join(rng.choices(words, cum_weights=odds, k=n // 4))[:n]

    learn = [(i, text(30 * 3 ** (i % 6 + 1) * 2), "en") for i in range(180)]
    long = [(900 + i, text(n), "en") for i, n in enumerate((200_000, 1_000_000, 3_000_000))]
    model = langid.fit(docs_of(learn))
    odd = [(1000, "żółw zgęśl jaźń szczyt łódź " * 20_000)]
    got = langid.predict(docs_of(long + odd), model, keep=["doc_id"]).collect()
    assert {r["doc_id"] for r in got if r["rejected"]} == {1000}
    assert langid.keep_known(docs_of(learn + long)).filter("doc_id >= 900").count() == 3


def test_frequencies_count_all_rows(docs_of, tongues):
    n, df = langid.document_frequencies(docs_of(tongues, 7), "text")
    letters = langid.Letters()
    want = sum((langid.counts(letters(t)) > 0).astype(int) for _, t, _ in tongues)
    assert n == len(tongues) and (df == want).all()


@pytest.fixture(scope="module")
def remarks():
    """Labelled texts: 1 if a bad word, or a word with a bad beginning, is in them."""
    rng = random.Random(6)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(700):
        words = [rng.choice(plain) for _ in range(rng.randint(1, 80))]
        y = int(rng.random() < 0.4)
        if y:
            bad = rng.choice(["zut", "ZUT!!", "krek" + rng.choice(plain), "krek" + rng.choice(plain)])
            words[rng.randrange(len(words))] = bad
        rows.append((i, " ".join(words), "en" if i % 2 else "fr", y))
    return rows


def test_toxicity_held_out(spark, docs_of, remarks):
    learn = [r for r in remarks if r[0] % 3 != 1]
    labels = spark.createDataFrame([(r[0], r[3]) for r in remarks] + [(None, 1), (10_000, 1), (5, None)],
                                   "doc_id long, toxic int")
    model = toxicity.fit(docs_of(learn), labels)
    assert set(model.shift) >= {""}
    got = {r["doc_id"]: r for r in toxicity.score(docs_of(remarks), model).collect()}
    told = [r for r in remarks if r[0] % 3 == 1]
    right = sum(got[i]["predicted"] == y for i, _, _, y in told)
    assert right >= 0.9 * len(told)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())


def test_toxicity_learns_from_all_rows(spark, docs_of, remarks, monkeypatch):
    """Whole long texts, every shard and all rows kept for the thresholds count."""
    long = [(i, t + " ja" * 8000 if y else t, lang, y) for i, t, lang, y in remarks]
    labels = spark.createDataFrame([(r[0], r[3]) for r in remarks], "doc_id long, toxic int")
    assert toxicity.fit(docs_of(long), labels).net is not None
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 200)
    whole, seen = toxicity.thresholds, []
    monkeypatch.setattr(toxicity, "thresholds", lambda check, *a: (seen.append(check.agg({"n": "sum"}).first()[0]), whole(check, *a))[1])
    model = toxicity.fit(docs_of(remarks), labels)
    assert seen == [sum(zlib.crc32(str(r[0]).encode()) % 4 == 3 for r in remarks)]
    again = toxicity.fit(docs_of(remarks[::-1]), labels)
    assert np.array_equal(model.net.embedding, again.net.embedding) and model.shift == again.shift
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs_of(remarks), model).collect()}
    assert sum(got[r[0]] == r[3] for r in remarks) >= 0.9 * len(remarks)


def test_best_threshold_of_counts():
    z = np.array([-1.0, 3.0, 0.5, 2.0])
    assert toxicity.best_threshold(z, np.array([0.0, 5, 0, 4]), np.array([9.0, 5, 6, 4])) == 1.25


def test_toxicity_odd_rows(spark, docs_of, odd_rows, remarks):
    labels = spark.createDataFrame([(r[0], r[3]) for r in remarks], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(remarks[:120]), labels)
    docs = docs_of(odd_rows)
    got = toxicity.score(docs, model)
    rows = got.collect()
    assert len(rows) == len(odd_rows) and got.columns.count("score") == 1
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs_of([]), model).count() == 0


def test_score_of_a_text_does_not_depend_on_its_neighbours(remarks):
    net = toxicity.train([r[1] for r in remarks[:100]], [r[3] for r in remarks[:100]], epochs=1)
    texts = [r[1] for r in remarks[:40]] + ["", "one"]
    together = toxicity.Scorer(net)(texts)
    alone = np.concatenate([toxicity.Scorer(net)([t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-4)


def brute_spans(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        doubled = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and doubled % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def test_fixed_spans_as_brute_force():
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice("ab01 .-@+%(é\n4") for _ in range(rng.randint(0, 60)))
        assert pii.fixed_spans(t) == brute_spans(t), t


def test_pii_learns_from_contexts(docs_of):
    rng = random.Random(8)
    rows = [(i, f"say w{i} write to: u{i}@mail.example please") for i in range(30)]
    rows += [(100 + i, f"word{i} write to: user{i}(at)mail please") for i in range(5)]
    rows += [(200 + i, f"the {rng.choice(['cat', 'dog'])} has {i}7 legs") for i in range(30)]
    got = {r["doc_id"]: r for r in pii.find(docs_of(rows)).collect()}
    for i in range(30):
        assert len(got[i]["base"]) == 1 and not got[200 + i]["learned"] and not got[200 + i]["base"]
    for i in range(5):
        text = rows[30 + i][1]
        assert [(s["kind"], text[s["start"]:s["stop"]]) for s in got[100 + i]["learned"]] == [(0, f"user{i}(at)mail")]


def test_pii_learns_where_half_is_unseen(docs_of):
    rows = [(i, f"say contact: u{i}@mail.example please") for i in range(20)]
    rows += [(100 + i, f"say contact: user{i}(at)host please") for i in range(10)]
    rows += [(200 + i, f"word{i} reach me under u{i}@post.example now") for i in range(4)]
    rows += [(300 + i, f"word{i} reach me under jo{'abcd'[i]} at host dot org now") for i in range(4)]
    rows += [(400 + i, f"call us +1 (017) 555-77{i} today") for i in range(10, 20)]
    rows += [(500 + i, f"call us 017 555 77{i} today") for i in range(10, 20)]
    # A context that ordinary numbers share is not one of identifiers.
    rows += [(600 + i, f"it is u{i}@mail.example then") for i in range(8)]
    rows += [(700 + i, f"it is {100 + i} then") for i in range(30)]
    rows += [(800 + i, f"the year{'abcdefgh'[i % 8]} {200 + i} was") for i in range(80)]
    got = {r["doc_id"]: r for r in pii.find(docs_of(rows)).collect()}
    text = dict(rows)
    learned = {d: [(s["kind"], text[d][s["start"]:s["stop"]]) for s in r["learned"]] for d, r in got.items() if r["learned"]}
    want = {100 + i: [(0, f"user{i}(at)host")] for i in range(10)}
    want |= {300 + i: [(0, f"jo{'abcd'[i]} at host dot org")] for i in range(4)}
    want |= {500 + i: [(3, f"017 555 77{i}")] for i in range(10, 20)}
    assert learned == want


def test_pii_odd_rows(docs_of, odd_rows):
    rows = odd_rows + [(50, "é 4111 1111 1111 1111 " * 3), (51, "+1 (017) 555-7713"), (52, "9" * 100_000),
                       (53, "1." * 50_000), (54, "a" * 100_000 + "@")]
    got = pii.find(docs_of(rows)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    told = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in got}
    for d, t in rows:
        if d is not None and d not in (6, 52, 53, 54):  # brute force is quadratic there
            assert told[d] == brute_spans(t or "")
    assert told[6] == told[52] == told[54] == [] and len(told[53]) == 12_500
    assert pii.find(docs_of([])).count() == 0


PAGE = ("<!DOCTYPE html><html><head><title>T{i}</title><script>var a='<p>';</script></head><body><nav><ul>{menu}</ul>"
        "</nav><div class=\"cookie-notice\">We use cookies</div>{body}<aside>Other {i}</aside><form><input name=q>"
        "</form><div id=comments><p>First!</p></div><footer>(c) {i}</footer></body></html>")


def pages(n, inner):
    return [PAGE.format(i=i, menu="".join(f"<li><a href=/{j}>m{j}</a></li>" for j in range(i % 5)), body=inner(i))
            for i in range(n)]


@pytest.mark.parametrize("shape", ["<article>{}</article>", "<main>{}</main>", "<div class=x>{}</div>"])
def test_main_text(spark, shape):
    def inner(i):
        return shape.format(f"<h1>Head {i}</h1>" + "".join(
            f"<p>Long text  number\n{j} &amp; <b>more</b> of {i}<br>next" for j in range(1 + i % 4)))

    rows = [(i, "https://User@Example.com:80/a", p) for i, p in enumerate(pages(30, inner))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old"))
    got = {r["page_id"]: r for r in wrappers.extract_text(df).collect()}
    for i in range(30):
        want = "\n".join([f"Head {i}"] + [f"Long text number {j} & more of {i} next" for j in range(1 + i % 4)])
        assert got[i]["text"] == want and got[i]["n_chars"] == len(want)


@pytest.mark.parametrize("shape", [
    "<body class='has-sidebar'><article>{}</article></body>", "<body class='sidebar'><main>{}</main></body>",
    "<body><main class='no-sidebar'>{}</main></body>", "<body><article class='post comments-open'>{}</article></body>",
    "<body><article class='widget'>{}</article></body>", "<body><div id='content' class='widget'>{}</div></body>"])
def test_names_do_not_hide_a_whole_article(shape):
    made = [f"<html>{shape.format(f'<h1>Head {i}</h1><p>Some text {i}</p>')}<footer>(c)</footer></html>" for i in range(6)]
    w = wrappers.infer(made)
    assert [wrappers.main_text(p, w) for p in made] == [f"Head {i}\nSome text {i}" for i in range(6)]


def test_wrapper_tells_content_from_template():
    made = [f"<html><body><div class=x1>Shop hours nine to five</div><article><h1>Head {i}</h1>"
            f"<p class=x2>All rights stay with the maker.</p>{'<div class=x3><a href=/a>More like this</a></div>' * (i % 2)}"
            f"<p>Some text {str(i) * 99} <i>as ever</i></p><p>As ever</p><p>Other {i * i}</p><p>Licence: free to copy</p></article>"
            f"<article class=x4><p>Join our club</p></article></body></html>" for i in range(8)]
    w = wrappers.infer(made)
    assert [wrappers.main_text(p, w) for p in made] == [
        f"Head {i}\nSome text {str(i) * 99} as ever\nOther {i * i}" for i in range(8)]
    # Pages that are copies of each other lose nothing.
    copies = [f"<article><p>One long text that all have</p><p>and this</p><p>{i}</p></article>" for i in range(8)]
    w = wrappers.infer(copies)
    assert [wrappers.main_text(p, w) for p in copies] == [f"One long text that all have\nand this\n{i}" for i in range(8)]


def test_wrapper_knows_rare_pages(spark):
    def page(i):
        odd = f"<article class='post sports'><p>Score of game {i}</p></article>" if i in (7, 150) else ""
        return f"<body>{odd}<article class='post news'><p>News number {i}</p></article></body>"

    rows = [(i, "http://h.example/a", page(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in wrappers.extract_text(df).collect()}
    assert got == {i: (f"Score of game {i}\n" if i in (7, 150) else "") + f"News number {i}" for i in range(300)}
    w = wrappers.infer([page(i) for i in range(20, 30)])
    assert wrappers.main_text(page(7), w) == got[7]


def test_wrapper_of_a_host():
    w = wrappers.infer(pages(8, lambda i: "<article><h1>H</h1>" + "<p>t{}</p>".format(i) * (i % 3) + "</article>"))
    flat = {}

    def walk(groups):
        for g in groups:
            flat[g["k"]] = g
            walk(g["kids"])

    walk(w)
    assert flat["li"]["rep"] and flat["article"].get("main")
    assert [(g["k"], g["rep"], g["opt"]) for g in flat["article"]["kids"]] == [
        ("h1", False, False), ("p", True, True)]
    texts = [g for g in flat["title"]["kids"]]
    assert texts[0]["text"] is None  # a slot
    assert flat["div cookie notice"]["kids"][0]["text"] == "We use cookies"  # the same on every page


def test_html_odd_rows(spark):
    rows = [(1, None, None), (2, "http://a/", None), (3, None, "plain &lt; text"), (4, "http://a/", ""),
            (None, "http://a/", "<p>x"), (5, "http://b/", "<div>" * 3000 + "deep"), (6, "http://b/", "<a href='"),
            (7, "not a url", "<!-- <p>no</p>"), (8, "http://c/", "<article>" + "<p>y</p>" * 5000 + "</article>"),
            (9, "http://c/", "&copy; &#233; &am"), (8, "http://c/", "<article>" + "<p>y</p>" * 5000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = wrappers.extract_text(df).collect()
    assert Counter(r["page_id"] for r in got) == Counter(r[0] for r in rows)
    told = {r["page_id"]: r["text"] for r in got}
    assert told[1] == told[2] == told[4] == told[7] == ""
    assert told[3] == "plain < text" and told[5] == "deep" and told[None] == "x"
    assert told[8] == "\n".join(["y"] * 5000)
    assert wrappers.extract_text(df.limit(0)).count() == 0
