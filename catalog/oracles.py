"""SQL for DuckDB, one statement per registered query.

Written against the given tables alone. Word lists and patterns are data and
come from the library; the rules around them are spelled out here again.
"""

from __future__ import annotations

from presswork import dictionaries as d
from presswork.functions.text import BLOCK, LINK
from presswork.operators import entities as e
from presswork.operators import sentiment as s


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words_in(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def word_count(x: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> ''))"


def values(rows) -> str:
    return "(VALUES " + ", ".join(
        "(" + ", ".join(quoted(c) if isinstance(c, str) else str(c) for c in r) + ")" for r in rows
    ) + ")"


def case_map(column: str, table: dict[str, str], default: str) -> str:
    arms = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in table.items())
    return f"CASE {column} {arms} ELSE {quoted(default)} END"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


URL = "'https://www.' || source || '.example.com/' || lang || '/' || doc_id"
TITLE = "CASE WHEN doc_id % 10 = 0 THEN 'Breaking: ' ELSE '' END || '<b>' || substr(text, 1, 60) || '</b>'"
COUNTRY = case_map("lang", {"en": "US", "fr": "FR", "de": "DE", "es": "ES"}, "Global")
PUBLISHED = "TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id)"

ARTICLES = rf"""articles AS (
  SELECT doc_id, lang, text, {URL} AS url, md5({URL}) AS id, {TITLE} AS title,
         '<p>' || text || '</p>' AS content, {COUNTRY} AS source_country,
         {PUBLISHED} AS ts,
         strftime({PUBLISHED}, '%a, %d %b %Y %H:%M:%S GMT') AS published_at,
         contains(lower({TITLE}), 'breaking') AS is_breaking_news
  FROM documents)"""

CLEANED = ARTICLES + r""", cleaned AS (
  SELECT *, trim(regexp_replace(title, '<[^>]+>', ' ', 'g')) AS clean_title,
         trim(regexp_replace(regexp_replace(content, '<[^>]+>', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g')) AS clean_content,
         regexp_extract(url, 'https?://(?:www\.)?([^/]+)', 1) AS domain
  FROM articles),
counted AS (
  SELECT *, CASE WHEN clean_content = '' THEN 0 ELSE len(string_split(clean_content, ' ')) END::INTEGER AS word_count,
         clean_title || chr(10) || chr(10) || clean_content AS full_text_payload
  FROM cleaned)"""

SILVER = CLEANED + """, silver AS (
  SELECT *, ceil(word_count / 200.0)::INTEGER AS est_read_time_mins, ts::DATE AS published_date
  FROM counted WHERE word_count >= 30)"""

DIRTY = (
    ARTICLES.replace(" AS ts,", " AS moment,")
    + """, dirty AS (
  SELECT CASE WHEN doc_id % 23 <> 3 THEN id END AS id, CASE WHEN doc_id % 29 <> 4 THEN title END AS title, url, source_country,
    CASE WHEN doc_id % 12 = 9 THEN '' ELSE content END AS content,
    CASE doc_id % 11 WHEN 5 THEN NULL WHEN 8 THEN NULL WHEN 7 THEN moment - INTERVAL 2 HOUR ELSE moment END AS ts
  FROM articles)"""
    + CLEANED.removeprefix(ARTICLES).replace("FROM articles", "FROM dirty WHERE id IS NOT NULL AND title IS NOT NULL")
    + SILVER.removeprefix(CLEANED)
)

SILVER_ROWS = f"""SELECT id, clean_title, md5(clean_content) AS content_md5, word_count, est_read_time_mins,
  domain, md5(full_text_payload) AS payload_md5, source_country, {stamp('ts')} AS published_at_ts,
  published_date::VARCHAR AS published_date FROM silver"""

ENTRIES = ARTICLES + r""", entries AS (
  SELECT doc_id, text, source_country, CASE WHEN doc_id % 19 <> 7 THEN url END AS url,
         CASE WHEN doc_id % 19 <> 7 THEN id END AS id, CASE WHEN doc_id % 13 <> 5 THEN title END AS raw_title,
         CASE WHEN doc_id % 13 <> 5 THEN title ELSE 'No Title' END AS title,
         doc_id % 13 <> 5 AND is_breaking_news AS is_breaking_news,
         CASE WHEN doc_id % 17 <> 6 THEN published_at ELSE '' END AS published_at,
         CASE WHEN doc_id % 5 <> 2 THEN text END AS extracted_text,
         trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS stripped
  FROM articles)"""

TRIAGED = ENTRIES + f""", triaged AS (
  SELECT *, {word_count('stripped')}::INTEGER AS word_count, substr(text, 1, 500) AS summary_snippet
  FROM entries)"""


# ------------------------------------------------------------ text tasks
# Each builder adds CTEs to a chain that has ``texts(k, x)``: key and text.


def language_cte() -> str:
    known = sorted({w for ws in d.FUNCTION_WORDS.values() for w in ws})
    counts = ", ".join(
        f"len(list_filter(toks, lambda t: t IN {words_in(ws)})) AS n_{code}"
        for code, ws in d.FUNCTION_WORDS.items()
    )
    codes = list(d.FUNCTION_WORDS)
    top = "greatest(" + ", ".join(f"n_{c}" for c in codes) + ")"
    arms = " ".join(f"WHEN n_{c} = {top} THEN '{c}'" for c in codes)
    return rf"""lang_tokens AS (
  SELECT k, list_filter(regexp_extract_all(lower(x), '\p{{L}}+'), lambda t: t IN {words_in(known)}) AS toks FROM texts),
lang_counts AS (SELECT k, {counts} FROM lang_tokens),
langs AS (SELECT k, CASE WHEN {top} = 0 THEN 'en' {arms} END AS lang FROM lang_counts)"""


def category_cte(keywords) -> str:
    scores = ", ".join(
        "(" + " + ".join(f"contains(lower(x), {quoted(t)})::INTEGER" for t in terms) + f")::INTEGER AS {name.lower()}"
        for name, terms in keywords.items()
    )
    names = [n.lower() for n in keywords]
    top = f"greatest({', '.join(names)})"
    arms = " ".join(f"WHEN {n.lower()} = {top} THEN '{n}'" for n in keywords)
    return f"""scores AS (SELECT k, {scores} FROM texts),
categories AS (SELECT k, CASE WHEN {top} = 0 THEN 'General' {arms} END AS category FROM scores)"""


def frequent_cte(stop_words, tie: str) -> str:
    return rf"""word_list AS (SELECT k, regexp_extract_all(lower(x), '[a-zA-Z][a-zA-Z0-9\-]{{2,}}') AS ws FROM texts),
word_rows AS (SELECT k, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM word_list),
word_counts AS (SELECT k, word, count(*) AS n, min(pos) AS pos FROM word_rows
  WHERE word NOT IN {words_in(stop_words)} GROUP BY k, word),
word_ranks AS (SELECT k, word, row_number() OVER (PARTITION BY k ORDER BY n DESC, {tie}) AS r FROM word_counts),
frequent AS (SELECT k, string_agg(word, '|' ORDER BY r) AS words FROM word_ranks WHERE r <= 8 GROUP BY k)"""


def keywords_cte(keywords, stop_words, tie: str) -> str:
    rows = values((c, t, i) for c, ts in keywords.items() for i, t in enumerate(ts))
    return (
        category_cte(keywords)
        + f""", dictionary(category, term, pos) AS {rows},
contained_ranks AS (SELECT k, term, row_number() OVER (PARTITION BY k ORDER BY pos) AS r
  FROM texts JOIN categories USING (k) JOIN dictionary USING (category) WHERE contains(lower(x), term)),
contained AS (SELECT k, string_agg(term, '|' ORDER BY r) AS words FROM contained_ranks WHERE r <= 8 GROUP BY k), """
        + frequent_cte(stop_words, tie)
        + r""", keywords AS (SELECT texts.k, categories.category,
  CASE WHEN NOT regexp_matches(lower(x), '[a-zA-Z][a-zA-Z0-9\-]{2,}') THEN ''
       ELSE coalesce(contained.words, frequent.words, '') END AS keywords
  FROM texts JOIN categories USING (k) LEFT JOIN contained USING (k) LEFT JOIN frequent USING (k))"""
    )


def entities_cte(places: str = words_in(d.GAZETTEER)) -> str:
    def tail(heads):
        return quoted(" (?:" + "|".join(heads) + ")$")

    # Plain words are matched last and dropped: no mention starts inside a word.
    mention = "|".join(f"(?:{p})" for p in (e.DATE, e.PERCENT, e.MONEY, e.LEAD, e.NAME, r"[\p{L}\p{Nd}]+"))
    event = quoted("(?:^| )(?:" + "|".join(d.EVENT_HEADS) + ")$")
    return rf"""mention_list AS (SELECT k, regexp_extract_all(x, {quoted(mention)}) AS ms FROM texts),
mention_rows AS (SELECT k, unnest(ms) AS m, unnest(range(len(ms))) AS pos FROM mention_list),
named AS (SELECT k, pos, m, regexp_full_match(m, {quoted(e.DATE)}) AS is_date,
    regexp_full_match(m, {quoted(e.PERCENT)}) AS is_percent, regexp_matches(m, '^[$€£¥]') AS is_money,
    m AS name
  FROM mention_rows WHERE regexp_matches(m, '^[\p{{Lu}}$€£¥0-9].*[^ ]$|^\p{{Lu}}$')),
labelled AS (SELECT k, pos, m AS text,
  CASE WHEN is_date THEN 'DATE' WHEN is_percent THEN 'PERCENT' WHEN is_money THEN 'MONEY'
    WHEN lower(name) IN {places} THEN 'GPE'
    WHEN regexp_matches(name, {tail(d.LOCATION_HEADS)}) THEN 'LOC'
    WHEN regexp_matches(name, {event}) AND (contains(name, ' ') OR name = 'Olympics') THEN 'EVENT'
    WHEN regexp_matches(name, {tail(d.ORGANIZATION_HEADS)}) OR lower(name) IN {words_in(d.ORGANIZATIONS)} THEN 'ORG'
    WHEN regexp_matches(name, '^[A-Z]{{2,6}}$') THEN 'ORG'
    WHEN contains(name, ' ') THEN 'PERSON' END AS label
  FROM named),
entities AS (SELECT k, (row_number() OVER (PARTITION BY k ORDER BY pos) - 1)::INTEGER AS position, text, label
  FROM labelled WHERE label IS NOT NULL)"""


def sentiment_cte() -> str:
    degrees = [(w, s.STEP) for w in d.STRENGTHENERS] + [(w, -s.STEP) for w in d.WEAKENERS]
    return rf"""lexicon(word, valence) AS {values(d.VALENCES.items())},
degrees(word, step) AS {values(degrees)},
tokens AS MATERIALIZED (SELECT k, len(ws) AS n, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (
  SELECT k, regexp_extract_all(x, '[\p{{L}}\p{{N}}_]+(?:[''’-][\p{{L}}\p{{N}}_]+)*') AS ws FROM texts)),
lowered AS MATERIALIZED (SELECT *, replace(replace(lower(w), '''', ''), '’', '') AS lw,
  length(w) > 1 AND w = upper(w) AND w <> lower(w) AS shout FROM tokens),
spans AS (SELECT k, max(n) AS n, count(*) FILTER (WHERE shout) AS shouted, min(i) FILTER (WHERE lw = 'but') AS turn
  FROM lowered GROUP BY k),
base AS (SELECT l.k, l.i, spans.turn,
    valence + CASE WHEN shout AND shouted < spans.n THEN CASE WHEN valence > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END AS v
  FROM lowered l JOIN lexicon ON lw = lexicon.word JOIN spans USING (k)
  WHERE lw NOT IN (SELECT word FROM degrees)),
nearby AS (SELECT b.k, b.i, b.v, b.turn,
    coalesce(sum(CASE WHEN p.lw NOT IN (SELECT word FROM lexicon) THEN
      coalesce(dg.step, 0) * CASE b.i - p.i WHEN 1 THEN 1.0 WHEN 2 THEN 0.95 ELSE 0.9 END END), 0) AS degree,
    count(*) FILTER (WHERE p.lw IN {words_in(d.NEGATIONS)}) AS negations
  FROM base b LEFT JOIN lowered p ON p.k = b.k AND p.i BETWEEN b.i - 3 AND b.i - 1
  LEFT JOIN degrees dg ON dg.word = p.lw GROUP BY ALL),
hits AS (SELECT k, (v + sign(v) * degree)::DOUBLE * power(-0.74, negations)
    * CASE WHEN turn IS NULL THEN 1.0 WHEN i < turn THEN 0.5 ELSE 1.5 END AS value FROM nearby),
sums AS (SELECT k, sum(value) AS total, sum(value + 1) FILTER (WHERE value > 0) AS up,
    sum(value - 1) FILTER (WHERE value < 0) AS down, count(*) FILTER (WHERE value <> 0) AS felt FROM hits GROUP BY k),
marks AS (SELECT k, least(length(x) - length(replace(x, '!', '')), 4) * 0.292
    + CASE WHEN q > 3 THEN 0.96 WHEN q > 1 THEN q * 0.18 ELSE 0 END AS m
  FROM (SELECT *, length(x) - length(replace(x, '?', '')) AS q FROM texts)),
weighed AS (SELECT t.k, coalesce(spans.n, 0) AS n, sums.k IS NULL AS flat, total + sign(total) * m AS total,
    CASE WHEN up > -down THEN up + m ELSE up END AS up, CASE WHEN up < -down THEN down - m ELSE down END AS down, felt
  FROM texts t LEFT JOIN spans USING (k) JOIN marks USING (k)
  LEFT JOIN (SELECT k, total, coalesce(up, 0) AS up, coalesce(down, 0) AS down, felt FROM sums) sums USING (k)),
sentiments AS (SELECT k,
  CASE WHEN flat THEN 0.0 ELSE round((total / sqrt(total * total + 15.0))::DOUBLE, 4) END::DOUBLE AS compound,
  CASE WHEN flat THEN 0.0 ELSE round((abs(up) / (up - down + n - felt))::DOUBLE, 3) END::DOUBLE AS positive,
  CASE WHEN flat THEN CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END
       ELSE round(((n - felt) / (up - down + n - felt))::DOUBLE, 3) END::DOUBLE AS neutral,
  CASE WHEN flat THEN 0.0 ELSE round((abs(down) / (up - down + n - felt))::DOUBLE, 3) END::DOUBLE AS negative
  FROM weighed)"""


LABEL = "CASE WHEN {0} >= 0.05 THEN 'Positive' WHEN {0} <= -0.05 THEN 'Negative' ELSE 'Neutral' END"
TEXTS = "texts AS (SELECT doc_id AS k, text AS x FROM documents)"
ENRICHED = (
    SILVER
    + r""", texts AS (SELECT id AS k, trim(regexp_replace(regexp_replace(full_text_payload, '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS x
  FROM silver), """
    + ", ".join(
        (language_cte(), keywords_cte(d.CATEGORY_KEYWORDS, d.STOP_WORDS, "word"), entities_cte(), sentiment_cte())
    )
    + f""", entity_lists AS (SELECT k, string_agg(text, '|' ORDER BY position) AS entities,
    string_agg(text, '|' ORDER BY position) FILTER (WHERE position < 10) AS top_entities,
    string_agg(text, '|' ORDER BY position) FILTER (WHERE label IN ('GPE', 'LOC')) AS places,
    count(*) FILTER (WHERE label IN ('GPE', 'LOC'))::INTEGER AS locations FROM entities GROUP BY k),
enriched AS (SELECT id AS article_id, clean_title AS title, domain, source_country,
    published_date::VARCHAR AS published_date, langs.lang AS detected_language, category, keywords,
    compound AS sentiment_polarity, {LABEL.format('compound')} AS sentiment_label,
    coalesce(entities, '') AS entities, coalesce(top_entities, '') AS top_entities,
    coalesce(locations, 0)::INTEGER AS locations, coalesce(places, '') AS places, texts.x, full_text_payload
  FROM silver JOIN texts ON texts.k = id JOIN langs ON langs.k = id JOIN keywords ON keywords.k = id
  JOIN sentiments ON sentiments.k = id LEFT JOIN entity_lists ON entity_lists.k = id)"""
)

# ------------------------------------------------------------ vectors and portal

NAMES = [*d.CATEGORY_KEYWORDS, "General"]
LIBRARY = f"""library AS (
  SELECT doc_id, vec_id, md5({URL}) AS article_id, embedding::DOUBLE[] AS v, {TITLE} AS title,
    'src' || substr(source, 4) || '.example.com' AS domain, {COUNTRY} AS source_country,
    (CASE label % 5 {' '.join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(NAMES))} END) AS category,
    round(embedding[1]::DOUBLE, 4) AS sentiment_score, lang AS language, text
  FROM documents JOIN embeddings ON doc_id = vec_id),
rows AS (SELECT *, {LABEL.format('sentiment_score')} AS sentiment_label FROM library)"""


PORTAL = ENRICHED + """, rows AS (SELECT article_id, title, source_country, category, sentiment_label,
  sentiment_polarity AS sentiment_score, detected_language AS language, x AS text FROM enriched)"""


def scored(target: str, where: str = "TRUE") -> str:
    return f"""{LIBRARY}, scored AS (SELECT r.*, list_cosine_similarity(r.v, t.v) AS score
  FROM rows r, (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = {target}) t WHERE {where})"""


BEST = "ORDER BY score DESC, article_id LIMIT {0}"
COLOR = case_map("category", d.CATEGORY_COLORS, "gray")


def ttl(key: str, interval: str) -> str:
    return f"""WITH RECURSIVE chain AS (
  SELECT {key}, min(ts) AS ts FROM events GROUP BY {key}
  UNION ALL
  SELECT c.{key}, min(e.ts) FROM chain c JOIN events e ON e.{key} = c.{key} AND e.ts >= c.ts + {interval} GROUP BY c.{key})
SELECT c.{key}, min(e.event_id) AS event_id, epoch_us(c.ts) AS ts_us
FROM chain c JOIN events e ON e.{key} = c.{key} AND e.ts = c.ts GROUP BY c.{key}, c.ts"""


EVENT_ROWS = ENTRIES + f""", scraped AS (
  SELECT *, {word_count('text')}::INTEGER AS word_count, substr(text, 1, 500) AS summary_snippet
  FROM entries WHERE extracted_text <> '' AND url IS NOT NULL)"""


def related(article: int, condition: str, limit: int) -> str:
    return f"""WITH {LIBRARY}, target AS (SELECT article_id, v FROM rows WHERE doc_id = {article}),
scored AS (SELECT r.*, list_cosine_similarity(r.v, t.v) AS score FROM rows r, target t
  WHERE r.article_id <> t.article_id AND {condition})
SELECT {{0}} FROM scored {BEST.format(limit)}"""


def decoded(x: str) -> str:
    for reference, character in {**d.HTML_ENTITIES, "&amp;": "&"}.items():
        x = f"replace({x}, {quoted(reference)}, {quoted(character)})"
    return x


DROPPED = (
    r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<nav\b.*?</nav>"
    r"|<head\b.*?</head>|<footer\b.*?</footer>"
)


def page_text(html: str) -> str:
    """Main text of the pages: articles, or else the blocks that are not mostly links."""
    return rf"""WITH kept AS (SELECT page_id, regexp_replace({html}, {quoted(DROPPED)}, ' ', 'g') AS h FROM pages),
blocks AS (SELECT page_id, h, list_filter(string_split_regex(h, {quoted(BLOCK)}), lambda b:
    2 * length(regexp_replace(array_to_string(regexp_extract_all(b, {quoted(LINK)}, 1), ''), '<[^>]+>', '', 'g'))
    <= length(regexp_replace(b, '<[^>]+>', '', 'g'))) AS own FROM kept),
main AS (SELECT page_id, coalesce(nullif(array_to_string(regexp_extract_all(h, '(?is)<article\b[^>]*>(.*?)</article>', 1), ' '), ''),
  array_to_string(own, ' ')) AS h FROM blocks),
plain AS (SELECT page_id, {decoded("regexp_replace(h, '<[^>]+>', ' ', 'g')")} AS t FROM main),
done AS (SELECT page_id, trim(regexp_replace(t, '[\s\p{{Z}}]+', ' ', 'g')) AS text FROM plain)
SELECT page_id, text, {word_count('text')}::INTEGER AS words FROM done"""


JSON_FIELDS = (
    "id", "title", "url", "source_country", "content", "published_at", "word_count",
    "is_breaking_news", "summary_snippet", "full_content", "article_id", "extracted_text", "ingest_timestamp",
)

FIRST_EVENTS = """SELECT user_id, event_id, epoch_us(ts) AS ts_us FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1"""

ORACLES = {
    "ingest_records": f"""WITH {TRIAGED} SELECT id, title, url, source_country, published_at, word_count,
  is_breaking_news, summary_snippet, md5(stripped) AS content_md5 FROM triaged WHERE word_count >= 30 AND url IS NOT NULL""",
    "ingest_rejects": f"""WITH {TRIAGED} SELECT id, url, word_count,
  CASE WHEN url IS NULL THEN 'no link' ELSE 'insufficient text' END AS reject_reason
  FROM triaged WHERE word_count < 30 OR url IS NULL""",
    "ingest_invalid": f"""WITH {EVENT_ROWS} SELECT id, concat_ws('|', CASE WHEN id LIKE 'a%' THEN 'title is missing' END,
  CASE WHEN id LIKE 'b%' THEN 'published_at is missing' END,
  CASE WHEN id LIKE 'b%' OR id LIKE 'c%' THEN 'word_count is missing' END) AS reasons
  FROM scraped WHERE regexp_matches(id, '^[abc]')""",
    "ingest_events": f"""WITH {EVENT_ROWS} SELECT id, title, source_country, word_count, is_breaking_news,
  summary_snippet, id AS article_id, md5(text) AS text_md5 FROM scraped""",
    "feed_items": f"""WITH {ENTRIES} SELECT url, raw_title AS title, nullif(published_at, '') AS published, source_country
  FROM entries""",
    "html_main_text": page_text("html"),
    "html_blocks_text": page_text(r"regexp_replace(html, '(?i)</?article\b[^>]*>', ' ', 'g')"),
    "page_domains": r"SELECT page_id, regexp_extract(url, 'https?://(?:www\.)?([^/]+)', 1) AS domain FROM pages",
    "topic_records": f"""WITH {EVENT_ROWS}, events_out AS (
  SELECT *, text AS body, text AS full_content, id AS article_id, NULL::VARCHAR AS ingest_timestamp FROM scraped)
SELECT source_country AS key, json_object({', '.join(f"'{c}', " + ('body' if c == 'content' else c) for c in JSON_FIELDS)})::VARCHAR AS value
FROM events_out""",
    "topic_to_bronze_stream": f"""WITH {EVENT_ROWS} SELECT id, title, source_country, published_at, word_count,
  is_breaking_news, md5(text) AS content_md5 FROM scraped""",
    "topic_to_bronze_batch": f"""WITH {EVENT_ROWS} SELECT source_country, count(*) AS articles,
  sum(word_count)::BIGINT AS words, count(*) FILTER (WHERE is_breaking_news) AS breaking FROM scraped GROUP BY 1""",
    "silver_articles": f"WITH {SILVER} {SILVER_ROWS}",
    "silver_dirty": f"WITH {DIRTY} {SILVER_ROWS}",
    "silver_stream": f"WITH {SILVER} {SILVER_ROWS}",
    "silver_doc_variant": rf"""WITH {ARTICLES}, counted AS (SELECT *, {word_count('content')}::INTEGER AS word_count FROM articles)
SELECT id, trim(lower(regexp_replace(title, '<[^>]+>', '', 'g'))) AS clean_title,
  md5(trim(lower(regexp_replace(content, '<[^>]+>', '', 'g')))) AS content_md5, word_count, is_breaking_news,
  floor(word_count / 200.0)::INTEGER AS est_read_time_mins, regexp_extract(url, 'https?://(?:www\.)?([^/]+)', 1) AS domain,
  {stamp('ts')} AS published_at_ts FROM counted WHERE word_count > 5""",
    "dedup_ttl": ttl("user_id", "INTERVAL 7 DAY"),
    "dedup_ttl_stream": ttl("user_id", "INTERVAL 7 DAY"),
    "dedup_ttl_late": ttl("user_id", "INTERVAL 7 DAY"),
    "dedup_ttl_crowded": ttl("event_type", "INTERVAL 7 DAY"),
    "dedup_ttl_rows": f"""WITH admitted AS (SELECT event_id FROM ({ttl("user_id", "INTERVAL 7 DAY")}))
SELECT event_id, user_id, event_type, value, props FROM events WHERE event_id IN (SELECT event_id FROM admitted)""",
    "dedup_first": FIRST_EVENTS,
    "dedup_first_stream": FIRST_EVENTS,
    "dedup_unseen": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "gold_nlp_input": f"""WITH {SILVER} SELECT id AS article_id, clean_title, md5(clean_content) AS content_md5,
  md5(full_text_payload) AS payload_md5, domain, source_country, {stamp('ts')} AS published_at_ts,
  published_date::VARCHAR AS published_date FROM silver""",
    "gold_search_features": f"""WITH {SILVER} SELECT id AS doc_id, clean_title AS title, url, domain, word_count,
  est_read_time_mins, {stamp('ts')} AS published_at_ts, published_date::VARCHAR AS published_date FROM silver""",
    "gold_daily_publisher_metrics": f"""WITH {SILVER} SELECT published_date::VARCHAR AS published_date, source_country, domain,
  count(id) AS total_articles, sum(word_count)::BIGINT AS total_word_count,
  round(sum(word_count)::DOUBLE / count(*), 2) AS avg_word_count,
  round(sum(est_read_time_mins)::DOUBLE / count(*), 2) AS avg_read_time_mins,
  {stamp('max(ts)')} AS latest_article_ts, {stamp('min(ts)')} AS earliest_article_ts
  FROM silver GROUP BY silver.published_date, source_country, domain""",
    "gold_tables_written": f"""WITH {SILVER} SELECT published_date::VARCHAR AS published_date, count(*) AS articles,
  sum(word_count)::BIGINT AS words, {stamp('max(ts)')} AS latest FROM silver GROUP BY silver.published_date""",
    "quality_report": f"""WITH {CLEANED} SELECT count(*) FILTER (WHERE word_count >= 30)::BIGINT AS kept_rows,
  count(*) FILTER (WHERE word_count < 30)::BIGINT AS rejected_rows,
  count(DISTINCT source_country) FILTER (WHERE word_count >= 30) AS countries,
  count(DISTINCT domain) FILTER (WHERE word_count >= 30) AS domains,
  round(avg(word_count) FILTER (WHERE word_count >= 30), 2) AS avg_word_count,
  count(*) FILTER (WHERE word_count >= 30 AND is_breaking_news)::BIGINT AS breaking_rows FROM counted""",
    "country_summary": f"""WITH {SILVER} SELECT source_country, count(*) AS total_articles,
  count(*) FILTER (WHERE is_breaking_news) AS breaking_articles, round(avg(word_count), 2) AS avg_word_count
  FROM silver GROUP BY 1""",
    "nlp_clean": rf"""WITH {ARTICLES}, done AS (SELECT doc_id,
  trim(regexp_replace(regexp_replace(content, '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS cleaned_text FROM articles)
SELECT doc_id, cleaned_text, {word_count('cleaned_text')}::INTEGER AS word_count FROM done""",
    "nlp_language": f"WITH {TEXTS}, {language_cte()} SELECT k AS doc_id, lang AS detected_language FROM langs",
    "nlp_translation_route": f"""WITH {TEXTS}, {language_cte()} SELECT k AS doc_id, lang AS detected_language,
  lang = 'fr' AS translation_applied, md5(CASE WHEN lang = 'fr' THEN '[fr] ' ELSE '' END || x) AS translated_md5
  FROM texts JOIN langs USING (k)""",
    "nlp_entities": f"""WITH {TEXTS}, {entities_cte()} SELECT k AS doc_id, position, text AS entity, label FROM entities""",
    "nlp_entities_table": rf"""WITH {TEXTS},
gazetteer AS (SELECT DISTINCT unnest(regexp_extract_all(lower(x), '\p{{L}}{{4,}}')) AS name FROM texts),
{entities_cte("(SELECT name FROM gazetteer)")} SELECT k AS doc_id, position, text AS entity, label FROM entities""",
    "nlp_locations": f"""WITH {TEXTS}, {entities_cte()}, gazetteer(name) AS {values((g,) for g in d.GAZETTEER)}
SELECT k AS doc_id, position, text AS location,
  lower(text) IN (SELECT name FROM gazetteer) OR lower(text) IN (SELECT 'src ' || source FROM documents) AS verified
FROM entities""",
    "nlp_category_scores": f"""WITH {TEXTS}, {category_cte(d.CATEGORY_KEYWORDS)}
SELECT k AS doc_id, technology, business, politics, sports FROM scores""",
    "nlp_category": f"WITH {TEXTS}, {category_cte(d.CATEGORY_KEYWORDS)} SELECT k AS doc_id, category FROM categories",
    "nlp_keywords": f"""WITH {TEXTS}, {keywords_cte(d.CATEGORY_KEYWORDS, d.STOP_WORDS, 'word')}
SELECT k AS doc_id, category, keywords FROM keywords""",
    "nlp_keywords_doc": f"""WITH {TEXTS}, {keywords_cte(d.CATEGORY_KEYWORDS_LONG, d.STOP_WORDS_LONG, 'pos')}
SELECT k AS doc_id, category, keywords FROM keywords""",
    "nlp_frequent_words": f"""WITH {TEXTS}, {frequent_cte(d.STOP_WORDS, 'word')}
SELECT k AS doc_id, coalesce(words, '') AS keywords FROM texts LEFT JOIN frequent USING (k)""",
    "nlp_term_frequency": rf"""WITH words AS (SELECT unnest(regexp_extract_all(lower(text), '[a-zA-Z][a-zA-Z0-9\-]{{2,}}')) AS word FROM documents)
SELECT word, count(*) AS n FROM words WHERE word NOT IN {words_in(d.STOP_WORDS)} GROUP BY word""",
    "nlp_sentiment": f"""WITH {TEXTS}, {sentiment_cte()} SELECT k AS doc_id, compound AS polarity_score,
  {LABEL.format('compound')} AS label FROM sentiments""",
    "nlp_sentiment_shares": f"WITH {TEXTS}, {sentiment_cte()} SELECT k AS doc_id, positive, neutral, negative FROM sentiments",
    "nlp_flattened": f"""WITH {ENRICHED} SELECT article_id, title, domain, source_country, published_date, detected_language,
  category AS predicted_category, sentiment_label, sentiment_polarity, keywords, entities, locations FROM enriched""",
    "nlp_saved_run": f"""WITH {ENRICHED} SELECT category AS predicted_category, detected_language, count(*) AS articles
  FROM enriched GROUP BY 1, 2""",
    "nlp_report": f"""WITH {ENRICHED} SELECT count(*) AS total,
  count(*) FILTER (WHERE detected_language <> 'fr' OR length(x) % 2 = 0) AS enriched FROM enriched""",
    "nlp_errors": f"""WITH {ENRICHED} SELECT 'translation' AS task, 'ValueError: odd length' AS reason, count(*) AS articles
FROM enriched WHERE detected_language = 'fr' AND length(x) % 2 = 1 GROUP BY ALL""",
    "portal_articles": f"""WITH {ENRICHED} SELECT article_id, title, domain, source_country, md5(x) AS text_md5, detected_language,
  FALSE AS translation_applied, category AS predicted_category, keywords, sentiment_label, sentiment_polarity FROM enriched""",
    "vec_payload": f"""WITH {ENRICHED} SELECT article_id, title, domain, source_country, published_date, category,
  sentiment_polarity AS sentiment_score, sentiment_label, detected_language AS language, top_entities AS entities,
  array_to_string(list_slice(string_split(places, '|'), 1, 5), '|') AS locations, keywords,
  md5(title || ' ' || full_text_payload) AS input_md5 FROM enriched""",
    "vec_indexed": f"""WITH {ENRICHED} SELECT article_id, title, category, sentiment_label, detected_language AS language,
  top_entities AS entities, keywords, 384::INTEGER AS vector_size FROM enriched""",
    "vec_upsert": """SELECT vec_id AS article_id, label FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, (100 + quality)::INTEGER FROM labels""",
    "vec_stats": f"""WITH {LIBRARY} SELECT 'news_articles' AS collection_name, count(*) AS vectors_count,
  max(len(v))::INTEGER AS vector_size, 'COSINE' AS distance_metric FROM rows""",
    "vec_search": f"""WITH {scored('0')} SELECT article_id, title, category, source_country,
  round(score, 6) AS similarity_score FROM scored {BEST.format(10)}""",
    "vec_search_filtered": f"""WITH {scored('1', "category = 'Technology' AND source_country = 'US' AND sentiment_label = 'Positive'")}
SELECT article_id, title, sentiment_label, round(score, 6) AS similarity_score FROM scored {BEST.format(5)}""",
    "vec_advanced": f"""WITH {scored('2', "source_country IN ('FR', 'DE') AND sentiment_label = 'Negative'")}
SELECT article_id, category, source_country, round(score, 6) AS similarity_score FROM scored WHERE score >= 0.05 {BEST.format(10)}""",
    "vec_related": related(3, "category = 'Sports'", 5).format(
        "article_id, title, category, round(score, 6) AS similarity_score"
    ),
    "vec_related_fallback": related(3, "TRUE", 5).format(
        "article_id, title, category, round(score, 6) AS similarity_score"
    ),
    "vec_related_batch": f"""WITH {scored('0')}, page AS (SELECT article_id AS target_id, v AS tv FROM scored {BEST.format(12)}),
pairs AS (SELECT target_id, article_id, list_cosine_similarity(v, tv) AS score FROM rows, page WHERE article_id <> target_id)
SELECT target_id, article_id, (row_number() OVER (PARTITION BY target_id ORDER BY score DESC, article_id))::INTEGER AS rank,
  round(score, 6) AS similarity_score FROM pairs QUALIFY rank <= 3""",
    "vec_browse": f"""WITH {LIBRARY} SELECT article_id, title, category, source_country FROM rows
WHERE category = 'Business' AND source_country = 'US' ORDER BY article_id LIMIT 10""",
    "vec_trending_sketch": f"""WITH {TEXTS}, {entities_cte()} SELECT text AS entity, count(*) AS n FROM entities
GROUP BY text ORDER BY n DESC, entity LIMIT 10""",
    "vec_trending": f"""WITH {TEXTS}, {entities_cte()} SELECT text AS entity, count(*) AS n FROM entities
GROUP BY 1 ORDER BY n DESC, entity LIMIT 10""",
    "query_category": "SELECT conv_id, turn, CASE "
    + " ".join(
        r"WHEN regexp_matches(lower(text), '(?:^|[^\p{L}\p{N}_])(?:" + "|".join(ts) + r")(?:$|[^\p{L}\p{N}_])')" + f" THEN '{c}'" for c, ts in d.QUERY_TERMS.items()
    )
    + " END AS category FROM conversations WHERE role = 'user'",
    "portal_facets": f"WITH {PORTAL} "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS facet, {c} AS value, count(*) AS articles FROM rows GROUP BY {c}"
        for f, c in (
            ("predicted_category", "category"), ("sentiment_label", "sentiment_label"), ("source_country", "source_country"),
        )
    ),
    "portal_filtered": f"""WITH {PORTAL} SELECT article_id, category AS predicted_category, sentiment_label, source_country FROM rows
WHERE category IN ('Technology', 'Sports') AND sentiment_label IN ('Positive', 'Neutral') AND source_country IN ('US', 'FR')""",
    "portal_kpis": f"""WITH {PORTAL}, shown AS (SELECT *, category IN ('Technology', 'Business') AND sentiment_label = 'Positive' AS hit FROM rows)
SELECT count(*)::BIGINT AS total_articles, count(*) FILTER (WHERE hit)::BIGINT AS filtered_articles,
  count(DISTINCT category) AS topics, round(avg(sentiment_score) FILTER (WHERE hit), 2) AS avg_sentiment FROM shown""",
    "portal_ranked": f"""WITH {scored('0')}, ranked AS (
  SELECT article_id, score, row_number() OVER (ORDER BY score DESC, article_id) - 1 AS rank FROM scored),
{ENRICHED}
SELECT article_id, enriched.title, rank, round(score, 6) AS similarity_score
FROM ranked JOIN enriched USING (article_id) WHERE enriched.category = 'Technology'""",
    "portal_pages": f"""WITH {PORTAL}, placed AS (SELECT article_id, row_number() OVER (ORDER BY sentiment_score DESC, article_id) - 1 AS pos FROM rows)
SELECT article_id, (pos // 3)::BIGINT AS grid_row, (pos % 3)::BIGINT AS grid_col FROM placed""",
    "portal_cards": f"""WITH {PORTAL} SELECT article_id, category AS predicted_category, {COLOR} AS color,
  {case_map('sentiment_label', d.SENTIMENT_MARKERS, '')} AS marker,
  CASE WHEN length(text) > 120 THEN substr(text, 1, 120) || '...' ELSE text END AS snippet,
  CASE WHEN sentiment_score > 0.05 THEN 'positive' WHEN sentiment_score < -0.05 THEN 'negative' ELSE 'neutral' END AS band,
  upper(language) AS language FROM rows""",
    "portal_detail": f"""WITH {PORTAL} SELECT article_id, title, category AS predicted_category, {COLOR} AS color,
  upper(language) AS language, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS text_preview,
  CASE WHEN sentiment_score > 0.05 THEN 'positive' WHEN sentiment_score < -0.05 THEN 'negative' ELSE 'neutral' END AS band
  FROM rows WHERE article_id = (SELECT md5({URL}) FROM documents WHERE doc_id = 3)""",
    "portal_keyword": f"""WITH {PORTAL} SELECT article_id, title FROM rows
WHERE contains(lower(title), 'tion the') OR contains(lower(text), 'tion the')""",
    "portal_related": related(3, "category = 'Sports'", 3).format(
        f"article_id, title, category, {COLOR} AS color, sentiment_label AS sentiment, source_country AS country, "
        "printf('%.2f%%', score * 100) AS match"
    ),
    "portal_collection_ranks": f"""WITH {scored('4')} SELECT article_id, row_number() OVER (ORDER BY score DESC, article_id) - 1 AS rank FROM scored""",
}

# The stored index gives what a scan of the collection does.
ORACLES |= {f"{name}_stored": ORACLES[name] for name in ("vec_search", "vec_related", "vec_advanced")}
