from pyspark.sql import functions as F

from presswork.functions import dates, text
from presswork.operators import enrich, silver


def words(n):
    return " ".join(f"w{i}" for i in range(n))


def test_titles_keep_double_spaces(one):
    raw = "Breaking: <em>New AI Model</em> Breaks Records"
    assert one(lambda x: F.trim(text.replace_tags(x, " ")), raw) == "Breaking:  New AI Model  Breaks Records"
    assert one(lambda x: F.trim(F.lower(text.replace_tags(x, ""))), raw) == "breaking: new ai model breaks records"


def test_domain(one):
    urls = ("https://www.bbc.co.uk/news/article", "https://techcrunch.com/2026/ai-news", "http://example.org/path/to/article", "ftp://a")
    assert one(text.domain_of, *urls) == ["bbc.co.uk", "techcrunch.com", "example.org", ""]


def test_dates(one):
    raw = ("Mon, 31 Aug 2026 09:45:00 GMT", "Tue, 01 Sep 2026 09:45:00 +0530", "2026-08-31T09:45:00Z", "", None, "31 Aug 2026")
    assert one(lambda x: dates.parse_published(x).cast("string"), *raw) == [
        "2026-08-31 09:45:00", "2026-09-01 04:15:00", None, None, None, None,
    ]
    assert one(lambda x: dates.parse_published(x, iso=True).cast("string"), *raw)[2] == "2026-08-31 09:45:00"


def test_word_counts(one):
    assert one(text.count_words, "a b  c\n", "", None, "  ") == [3, 0, 0, 0]
    assert one(lambda x: silver.space_count_words(x), "", "a b", None) == [0, 2, 0]


def test_reading_time(spark):
    df = spark.createDataFrame([(100,), (500,), (1200,), (2500,)], "n int")
    assert [r[0] for r in df.select(silver.read_minutes(F.col("n"))).collect()] == [1, 3, 6, 13]


def test_clean_text(one):
    assert one(text.clean_text, "<p>The <strong>AI</strong> revolution   is here.</p>") == "The AI revolution is here."
    assert one(text.clean_text, None, "", "a  b") == ["", "", "a b"]


def test_main_text(one):
    page = (
        "<html><head><title>t</title><script>var a='<p>'</script></head><body><nav>menu</nav>"
        "<!-- note --><article class='x'><h1>A &amp; B</h1>\n<p>caf&#233; &lt;b&gt; &amp;lt;</p></article>"
        "<footer>&copy;</footer></body></html>"
    )
    assert one(text.main_text, page) == "A & B café <b> &lt;"
    assert one(text.main_text, "<body><p>only body</p></body>") == "only body"
    assert one(lambda x: text.main_text(x, 30), f"<p>{words(29)}</p>", f"<p>{words(30)}</p>") == ["", words(30)]
    assert one(text.main_text, None) == ""


def test_previews(one):
    assert one(lambda x: text.preview(x, 5), "12345", "123456", None) == ["12345", "12345...", None]


def test_mojibake(one):
    assert one(enrich.repair_text, "cafÃ© â€“ ok", "café", "plain", None) == ["café – ok", "café", "plain", None]


def test_references_of_all_kinds(one):
    pages = ["&#x2014;&eacute;&Omega; &amp;lt; &nosuch; &#8212;", "a &amp; b &hellip; &#39;", "AT&T &lt;b&gt;", None]
    assert one(text.decode_entities, *pages) == ["—éΩ &lt; &nosuch; —", "a & b … '", "AT&T <b>", None]


def test_page_without_article_loses_its_menus(one):
    page = (
        "<body><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News and <b>more</b></a> |</li></ul>"
        "<div class='x'>Body text with <a href='/c'>a link</a> in it.</div><p>Second.</p><div><a>Imprint</a> <a>Contact</a></div></body>"
    )
    assert one(text.main_text, page, "<p>plain</p>") == ["Body text with a link in it. Second.", "plain"]
