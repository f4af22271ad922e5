import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from supplylens.llm import html_extraction, url_filter
from supplylens.llm.common import read
from tests.conftest import SMALL
from tests.llm.conftest import clashing

PAGES = [
    ("<html><body><nav><a>Menu</a></nav><article><h1>T &amp; x</h1><p><b>One\n two<br><p>Three</article><footer>f</footer>", "T & x\nOne two\nThree"),
    ("<p>a &lt;b&gt; &#233;&eacute;&nbsp;c &copy", "a <b> éé c ©"),
    ("<main><p>x</p><aside>no</aside><form><p>no</p></form><script>var a='</p>'</script><p>y</p></main>", "x\ny"),
    ("<div id='content'>text <span>in</span>line</div><div class=\"cookie-notice\">Accept</div>", "text inline"),
    ("<header>Site</header><article><header><h1>Title</h1></header><p>Body</p><div class='comments'><p>Nice</p></div></article>", "Title\nBody"),
    ("<!-- <p>no</p> --><style>p{}</style><p>a < b</p><p>tail", "a < b\ntail"),
    ("", ""),
    (None, ""),
    ("plain text only", "plain text only"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>", "one\ntwo\nc1\nc2"),
    ("<article><p>whole</p></article><p hidden>gone</p><p", "whole"),
]


@pytest.mark.parametrize("html, text", PAGES)
def test_blocks(html, text):
    assert "\n".join(b[2] for b in html_extraction.parse(html or "")) == text


def test_extraction_of_rows(spark):
    rows = [(i, f"http://h{i}.com/", h) for i, (h, _) in enumerate(PAGES)] + [(None, None, PAGES[0][0])] * 2
    df = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r["page_id"]: r for r in html_extraction.extracted(df).collect()}
    assert html_extraction.extracted(df).count() == len(rows)
    for i, (_, text) in enumerate(PAGES):
        assert got[i]["text"] == text and got[i]["n_chars"] == len(text)
    assert html_extraction.extracted(df.limit(0)).count() == 0


def test_text_on_every_page_of_a_host_goes(spark):
    page = "<body><div class='top'>Best site ever</div><div class='story'><p>Story {0} is told here</p></div></body>"
    rows = [(i, "http://one.com/a", page.format(i)) for i in range(40)]
    got = html_extraction.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r["text"] == f"Story {r['page_id']} is told here" for r in got)


def extracted_texts(spark, pages):
    rows = [(i, "http://one.com/a", p) for i, p in enumerate(pages)]
    got = html_extraction.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])]


@pytest.mark.parametrize("note", ["<div class='hint'>Get our letter</div>", "<p>Get our letter</p>"])
def test_text_repeated_inside_articles_goes(spark, note):
    page = "<article><h1>Title {0}</h1><p>Story {0} is told here</p>" + note + "</article>"
    got = extracted_texts(spark, [page.format(i) for i in range(40)])
    assert got == [f"Title {i}\nStory {i} is told here" for i in range(40)]


def test_body_beside_a_teaser_article_stays(spark):
    page = "<div class='story'><p>Story {0} is told here</p></div><article><p>Teaser {0}</p></article><nav>Menu</nav>"
    for n in (1, 40):
        assert extracted_texts(spark, [page.format(i) for i in range(n)]) == [f"Story {i} is told here\nTeaser {i}" for i in range(n)]


@pytest.mark.parametrize("n", [1, 7, 8, 63, 64, 300])
def test_marked_branches_are_out_on_hosts_of_any_size(spark, n):
    """Comments, adverts, forms and sidebars differ from page to page like stories do."""
    page = (
        "<div class='story'><p>Story {0} is told here</p></div><div class='comments'><p>Reader {0} says o{0}</p></div>"
        "<div class='advert'><p>Buy product {0} now</p></div><form><p>Form text {0}</p></form><aside><p>Side {0}</p></aside>"
    )
    assert extracted_texts(spark, [page.format(i) for i in range(n)]) == [f"Story {i} is told here" for i in range(n)]


def test_one_rule_for_repeated_texts_at_all_sizes(spark):
    """A notice on all pages goes as soon as the evidence is there, and stays gone on larger hosts."""
    page = "<div><p>Story {0} is told here</p></div><div class='remark'><p>Please read our notice</p></div>"
    gone = []
    for n in (1, 2, 5, 7, 8, 9, 40):
        got = extracted_texts(spark, [page.format(i) for i in range(n)])
        assert all(t.startswith(f"Story {i} is told") for i, t in enumerate(got))
        gone.append(not any("notice" in t for t in got))
    assert gone == [False, False, True, True, True, True, True]


def plain_extraction(pages, w=html_extraction.Weights()):
    """The style tree of one host in dictionaries."""
    rows = [html_extraction.dom_blocks(h) for h in pages]
    copies = {repr([b for b in r if b[1]] or r): r for r in rows}.values()
    on, have = defaultdict(set), defaultdict(set)
    for i, r in enumerate(copies):
        for node, shown, text in r:
            on[node, shown, text].add(i)
            have[node, shown].add(i)
    m = {k: math.log(max(len(v), w.pages)) for k, v in have.items()}
    mean = {}
    for k in have:
        c = [len(v) for (*node, _), v in on.items() if tuple(node) == k]
        mean[k] = sum(x * math.log(x) for x in c) / sum(c) / m[k]

    def important(shown, entropy):
        feature = w.main if shown == html_extraction.MAIN else w.neutral
        return w.presentation * feature + (1 - w.presentation) * (1 - entropy) >= w.least

    def stays(node, shown, text):
        k = (node, shown)
        own = math.log(max(1, len(on[node, shown, text]))) / m[k]
        return shown != html_extraction.MARKED and important(shown, mean[k]) and important(shown, own)

    return ["\n".join(b[2] for b in r if stays(*b)) for r in rows]


@pytest.mark.parametrize("n", [3, 20, 70])
def test_matches_a_plain_style_tree(spark, n):
    rng = random.Random(n)
    part = lambda: rng.choice(
        ["<p>Common {}</p>", "<article><p>Told {}</p></article>", "<nav>Menu {}</nav>", "<div class='x'>Text {}</div>", "<form>Ask {}</form>"]
    ).format(rng.choice([1, 2, rng.randint(3, 60)]))
    pages = ["".join(part() for _ in range(rng.randint(1, 9))) for _ in range(n)]
    assert extracted_texts(spark, pages + pages[:2]) == plain_extraction(pages + pages[:2])


def test_articles_stay_whole(spark):
    pages = read(spark, SMALL, "pages")
    for r in html_extraction.extracted(pages).join(pages.select("page_id", "html"), "page_id").collect():
        assert r["text"] and "track(" not in r["text"] and "</" not in r["text"]
        inside = r["html"].split("<article>")[1].split("</article>")[0]
        assert len(r["text"]) > 0.5 * len(inside)


def rule_of(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = lambda s, marks: s[: min([s.index(m) for m in marks if m in s], default=len(s))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in cut(rest, "/?#"))
    path = cut(rest[len(host) :], "?#")
    fit = [(v, t) for v, t in url_filter.RULES if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/") :])]
    return host, path, max(fit, key=lambda r: len(r[1]), default=None)


def test_rules_and_verdicts(spark):
    odd = [(None, None), (1, ""), (2, "no scheme"), (3, "http://A.Example.COM/en/x?y#z"), (4, "x://net/fr/"), (5, "http://www.example.com/en/1")]
    odd += [(6, "http://a.net"), (7, "http://ünï.net/es/ü"), (8, "http://example.com?/en/"), (8, "http://example.com?/en/"), (9, "://com/")]
    odd = clashing(spark.createDataFrame(odd, "page_id long, url string"))
    for df in (read(spark, SMALL, "pages"), odd):
        want = []
        for r in df.collect():
            host, path, rule = rule_of(r["url"])
            want.append((r["page_id"], host, path, rule and rule[1], rule and rule[0]))
        got = url_filter.judged(df).collect()
        assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None) for r in got) == Counter(want)
        assert {r["verdict"] for r in got} <= {"allow", "block"}
    assert url_filter.judged(odd.limit(0)).count() == 0
    assert {r["verdict"] for r in url_filter.judged(odd.where("page_id in (1, 2, 6)")).collect()} == {"allow"}


def test_models_tell_rejected_hosts(spark):
    rows = [(i, f"http://good{i % 7}.com/item/{i}") for i in range(200)] + [(1000 + i, f"http://casino{i % 5}.net/fr/win/{i}") for i in range(200)]
    rows += [(2000 + i, f"http://casino{i % 5}.org/win/{i}") for i in range(20)] + [(3000 + i, f"http://good{i % 7}.org/item/{i}") for i in range(20)]
    got = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string")).where(F.col("rule").isNull()).collect()
    right = sum((r["page_id"] >= 3000) == (r["verdict"] == "allow") for r in got)
    assert right >= 36


def plain_score(address, labelled, m):
    """Score of an address from dictionaries of contexts."""
    if not address:
        return 0.0
    counts = {v: (Counter(), Counter()) for v in ("allow", "block")}

    def grams(text):
        data = b"\0" * m.order + text.encode() + b"\n"
        for i in range(m.order, len(data)):
            yield [(data[i - k : i], data[i]) for k in range(m.order + 1)]

    for text, verdict in labelled:
        for orders in grams(text):
            for context, char in orders:
                counts[verdict][0][context, char] += 1
                counts[verdict][1][context] += 1
    total = 0.0
    for orders in grams(address):
        for verdict, sign in (("allow", 1), ("block", -1)):
            p = 1 / 256
            for context, char in orders:
                p = (counts[verdict][0][context, char] + m.prior * p) / (counts[verdict][1][context] + m.prior)
            total += sign * math.log(p)
    return total / (len(address.encode()) + 1)


def test_scores_are_exact_with_many_contexts(spark):
    rng = random.Random(4)
    path = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789é") for _ in range(60))
    rows = [(i, f"http://site{i % 9}.{rng.choice(['com', 'net/es', 'net/fr', 'org'])}/{path()}") for i in range(12000)]
    rows += [(None, "http://x.org/a"), (2**60 + 1, "http://x.org/b"), (None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    m = url_filter.Markov(block=3000)
    got = url_filter.judged(df, m=m).collect()
    assert Counter(r["page_id"] for r in got) == Counter(i for i, _ in rows)
    labelled = [(r["host"] + r["path"], r["verdict"]) for r in got if r["rule"]]
    assert len({(a[i : i + 5]) for a, _ in labelled for i in range(len(a))}) > 1 << 18
    some = [r for r in got if not r["rule"]][:3] + [r for r in got if not r["page_id"] or r["page_id"] > 10**6]
    for r in some:
        assert math.isclose(r["score"], plain_score(r["host"] + r["path"], labelled, m), abs_tol=2e-9)
