"""PII, quality, language and HTML extraction against plain Python."""

import re
from collections import Counter

import numpy as np
import pytest

from shelfrank.llm import language
from shelfrank.llm.html_text import extract_text, main_text
from shelfrank.llm.language import codewords, identify_languages
from shelfrank.llm.pii import find_pii, mask_pii
from shelfrank.llm.text import draw_limit
from shelfrank.llm.quality import STATS, choose_threshold, judge_documents, rule_statistics

ODD = [None, "", " \n\t ", "a", "é\n\n\né\né", "x " * 30000 + "end", "tie tie tie tie", "日本 語 日本 語 日本 語"]


# PII


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def digits(text):
    return re.sub("[^0-9]", "", text)


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
)


def plain_spans(text):
    out = [(m.start(), i, m.end(), k) for i, (k, p, ok) in enumerate(PLAIN) for m in re.finditer(p, text or "") if ok(m.group())]
    return sorted(out)


PII_TEXTS = [
    "a@b.c_d@e.f x@y", "..a+b%c@d-e.f.g..h@i.j", "é@x.yz.", "a@b@c.de", "1.2.3.4.5.6.7.8 256.1.1.1 0255.000.1.9 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111 1 1", "+1 (017) 555-7713 +49 30 1234567890123456 +1-2", "+1+2+3 4567890123",
    "日本 +81 3 1234 5678 tel é 10.0.0.1", "IBAN GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33",
    "call me: 555-123-4567 now", "only 555-123-4567 here", "x@y.zz " * 700, "7" * 20000, "a" * 50000 + "@b.c", "1." * 20000,
    "0" * 30000 + ".1.2.3", *ODD,
]


def test_base_spans_equal_plain_python(spark):
    docs = spark.createDataFrame([(i, t, "pii", "row") for i, t in enumerate(PII_TEXTS)], "i int, text string, pii string, row string")
    found = find_pii(docs)
    assert found.columns == ["i", "text", "row", "pii"]
    for r in found.collect():
        base = [(s["start"], s["rank"], s["end"], s["kind"]) for s in r["pii"] if s["base"]]
        assert base == plain_spans(PII_TEXTS[r["i"]]), r["i"]


def test_method_adds_spans(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(PII_TEXTS)], "i int, text string")
    more = {r["i"]: [(s["kind"], PII_TEXTS[r["i"]][s["start"] : s["end"]]) for s in r["pii"] if not s["base"]] for r in find_pii(docs).collect()}
    assert more[9] == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert more[10] == [("phone", "555-123-4567")]
    assert more[11] == []


IBANS = [
    ("IBAN DE89 3704 0044 0532 0130 00 Die Bank", ["DE89 3704 0044 0532 0130 00"]), ("Konto DE89370400440532013000 24 Uhr", ["DE89370400440532013000"]),
    ("IBAN DE89 3704 0044 0532 0130 00 und", ["DE89 3704 0044 0532 0130 00"]), ("Konto DE89370400440532013000X", []),
    ("bank DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32 A1", ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"]),
    ("konto É DE88370400440532013000 24 Uhr", []), ("bank NO93 8601 1117 947 OG 5 A 7 B 9 C 1 D 3 E 5 F 7 G 9 H", ["NO93 8601 1117 947"]),
]


def test_account_codes_before_words_and_numbers(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(IBANS)], "i int, text string")
    for r in find_pii(docs).collect():
        text, codes = IBANS[r["i"]]
        assert [text[s["start"] : s["end"]] for s in r["pii"] if s["kind"] == "iban"] == codes, text


def test_masks(spark):
    docs = spark.createDataFrame([(1, "é a@b.cd, 10.0.0.1!", 3, "x"), (2, None, None, "x"), (3, "none", 4, "x")], "row int, text string, n_chars long, done string")
    masked = mask_pii(docs)
    assert masked.columns == docs.columns
    assert [tuple(r) for r in masked.orderBy("row").collect()] == [(1, "é <EMAIL>, <IP>!", 16, "x"), (2, None, None, "x"), (3, "none", 4, "x")]
    assert mask_pii(docs.limit(0)).count() == 0


# Quality


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(lines), len(covered),
        len(re.findall("[A-Z]", text or "")), len(re.findall("[0-9]", text or "")), len(re.findall("[!?]", text or "")),
    )


def test_statistics_equal_plain_python(spark):
    rng = np.random.default_rng(1)
    texts = [*ODD, *PII_TEXTS] + ["".join(rng.choice(list("ab é\n#|A1!\t"), int(rng.integers(0, 300)))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in rule_statistics(docs).collect():
        assert tuple(r[c] for c in STATS) == plain_statistics(texts[r["doc_id"]]), r["doc_id"]


def test_forest_keeps_usual_texts_and_drops_odd_ones(spark):
    rng = np.random.default_rng(2)
    usual = [" ".join("w" * int(n) + chr(97 + j % 26) + chr(97 + j // 26) for j, n in enumerate(rng.integers(1, 6, 120))) for _ in range(400)]
    odd = [" ".join(f"w{i}{j}###$$$" for j in range(100)) for i in range(30)]
    texts = [*usual, *odd, *ODD]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(0, 430, 2)] + [(3, None), (None, 1)], "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in judge_documents(docs, labels).collect()}
    assert len(kept) == len(texts)
    assert sum(kept[i] for i in range(400)) >= 396
    assert not any(kept[i] for i in range(400, 430 + len(ODD)))
    assert all(r["kept"] for r in judge_documents(docs.where("doc_id < 50"), labels.limit(0)).collect())
    assert judge_documents(docs.limit(0), labels).count() == 0


def test_threshold_misjudges_fewest():
    assert choose_threshold(np.array([10, 20, 30]), np.array([90, 1, 5]), np.array([100, 20, 6])) == 20
    assert choose_threshold(np.array([10]), np.array([9]), np.array([10])) > 4096
    assert choose_threshold(*[np.zeros(0, dtype=int)] * 3) > 4096


# Language


def test_languages_on_held_out_rows(spark):
    found = identify_languages(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_every_language_is_drawn_without_ids(spark):
    rows = [(None, f"{word} {i} {word * 3}", lang) for lang, word in (("aa", "plain"), ("bb", "wörter")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    assert language.fit_language_model(docs, 20).languages == ["aa", "bb"]


def test_draws_spread_rows_without_ids_and_are_never_empty(spark):
    texts = [(None if i % 3 else i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(3000)]
    stats = rule_statistics(spark.createDataFrame(texts, "doc_id long, text string"))
    drawn = [r["doc_id"] for r in stats.where(stats["draw"] <= draw_limit(0.1)).collect()]
    assert 200 < len(drawn) < 400
    assert 0.5 < drawn.count(None) / len(drawn) < 0.8
    assert draw_limit(1e4 / 5e10) > 1 << 40 and draw_limit(0.0) == 0 and draw_limit(2.0) == (1 << 63) - 1


def test_languages_of_odd_texts(spark):
    rows = [(i, t, "aa" if i % 2 else "bb") for i, t in enumerate([*ODD, "123 !", "plain words", "andere wörter"] * 3)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, lang string, lang_pred string")
    for r in identify_languages(docs).collect():
        text = rows[r["doc_id"]][1]
        assert (r["lang_pred"] == "und") == (text is None or not any(c.isalpha() for c in text))
        assert r["lang_pred"] in ("aa", "bb", "und")
    assert {r["lang_pred"] for r in identify_languages(docs.withColumn("lang", docs["lang_pred"].substr(2, 0)).limit(0)).collect()} == set()


@pytest.mark.parametrize("classes", [1, 2, 3, 5, 6, 30])
def test_codewords_differ(classes):
    code = codewords(classes)
    assert code.shape[0] == classes
    assert len({tuple(row) for row in code}) == classes
    assert language.DIMENSIONS == 4096


# HTML

PAGES = [
    ("<html><body><nav><ul><li><a href=x>Home</a></ul></nav><article><h1>Head &amp; line</h1><p>One  two\nthree<br>four<p><b>Fünf</b> &lt;six&gt;"
     "<div class='comments'><p>The comment is by the one who was with it and that is all of it.</p></div><aside>x</aside></article><footer>f</footer>",
     "Head & line\n\nOne two three four\n\nFünf <six>"),
    (None, ""), ("", ""), ("<p>", ""), ("just text", ""), ("<!-- <article><p>no</p></article> -->", ""),
    ("<article><script>var a='<p>no</p>';</script><p>yes</p><form><p>name</p></form><style>p{}</style></article>", "yes"),
    ("<article><p>unclosed <i>text", "unclosed text"),
    ("<article><p>a < b & c &nbsp; d</p></article>", "a < b & c d"),
    ("<div>" + "The cat is on the mat and it was with the dog in the house. " * 5 + "</div><div><a href=x>More of the links that are here for you</a></div>",
     ("The cat is on the mat and it was with the dog in the house. " * 5).strip()),
    ("<article>" + "<p>word</p>" * 3000 + "</article>", "\n\n".join(["word"] * 3000)),
    ('<article><div id="cookie-notice"><p>We use cookies</p></div><ul><li>first</li><li>second</li></ul></article>', "first\n\nsecond"),
]


@pytest.mark.parametrize("number", range(len(PAGES)))
def test_pages(number):
    page, text = PAGES[number]
    assert main_text(page) == text


PROSE = "The cat is on the mat and it was with the dog in the house."
PLACES = [
    (f'<div class="page with-sidebar"><article><p>{PROSE}</p></article></div>', PROSE),
    (f'<div id="post" class="has-comments no-ads"><article><p>{PROSE}</p></article></div>', PROSE),
    (f'<div class="header sidebar"><main><p>{PROSE}</p></main></div>', PROSE),
    (f'<article><div title="a hidden gem" data-class="ad"><p>{PROSE}</p></div></article>', PROSE),
    (f"<article><div hidden><p>{PROSE}</p></div><div class='x hidden'><p>{PROSE}</p></div><p>one</p></article>", "one"),
    (f"<article><div style='display: none'><p>{PROSE}</p></div><div aria-hidden=true><p>{PROSE}</p></div><p>one</p></article>", "one"),
    (f"<nav><article><p>{PROSE}</p></article></nav><div hidden><article><p>{PROSE}</p></article></div>", ""),
    (f"<article><p>one</p><div class=comments><article><p>{PROSE}</p></article></div></article>", "one"),
    (f"<section id=comments><article class=comment><p>{PROSE}</p></article></section>", ""),
]

FOREIGN = (
    "Wczoraj wieczorem w centrum miasta odbył się koncert, który przyciągnął tłumy mieszkańców oraz turystów z całego kraju;"
    " organizatorzy zapowiedzieli kolejne wydarzenia jeszcze tego lata, również poza stolicą i na wybrzeżu."
)
DENSE = "昨日の夕方、市の中心部でコンサートが開かれ、国内各地から多くの住民や観光客が集まった。主催者は今年の夏に首都以外でもさらに催しを行うと発表した。"
LONG_PROSE = " ".join([PROSE] * 4)
PLACES += [
    (f"<form id=aspnetForm><nav>Menu</nav><div><p>{LONG_PROSE}</p></div><label>Name</label></form>", LONG_PROSE),
    (f"<form id=f><article><p>{PROSE}</p></article></form><footer>x</footer>", PROSE),
    (f"<article><p>{PROSE}</p></article><form><p>{LONG_PROSE}</p></form>", PROSE),
    (f"<div><p>{LONG_PROSE}</p></div><form><p>{PROSE}</p></form>", LONG_PROSE),
    (f'<div class="topic social-sciences"><p>{LONG_PROSE}</p></div>', LONG_PROSE),
    (f'<article><div class="post-header"><h1>Head</h1></div><p>{PROSE}</p></article>', f"Head\n\n{PROSE}"),
    (f"<div class='ad-slot-2'><p>{LONG_PROSE}</p></div><div id=related-posts><p>{LONG_PROSE}</p></div>", ""),
    (f"<div class=comment-list><p>{LONG_PROSE}</p></div><div><h2>Tytuł</h2><p>{FOREIGN}</p></div><ul><li><a href=x>Strona</a></ul>",
     f"Tytuł\n\n{FOREIGN}"),
    (f"<div><p>{DENSE}</p></div>", DENSE),
    (f"<article><p>{PROSE}</p><p><a href=x>{LONG_PROSE}</a></p><ul><li><a href=x>Home</a></ul></article>", f"{PROSE}\n\n{LONG_PROSE}"),
    ("<article><p>one <button>Buy</button><label>l</label><span hidden>h</span><span class=ad>ad</span>two"
     " <span class=comment>three</span></p></article>", "one two three"),
]


@pytest.mark.parametrize("number", range(len(PLACES)))
def test_marked_places(number):
    page, text = PLACES[number]
    assert main_text(page) == text


def test_extract_text(spark):
    rows = [(i, None if i % 2 else "u", page, "x") for i, (page, _) in enumerate(PAGES)] + [(None, None, None, None), (0, "u", PAGES[0][0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = extract_text(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["text"] == ("" if r["page_id"] is None else PAGES[r["page_id"]][1])
        assert r["n_chars"] == len(r["text"])
    assert extract_text(pages.limit(0)).count() == 0
