"""The same queries as plain SQL over the given tables."""

from __future__ import annotations

from guestlens.catalog.stop_words import ENGLISH_STOP_WORDS
from guestlens.catalog.views import CITY, CITY_HOTEL, HOTEL, TEXT_CITY
from guestlens.functions import labels, vocabulary
from guestlens.operators import sentiment
from guestlens.schemas import CATEGORIES

# Building blocks

SPACES = r"\s\x{0b}\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BREAKS = r"[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def clean(c: str, joiner: str = "") -> str:
    breaks = rf"\r\n|{BREAKS}" if joiner else BREAKS
    joined = f"regexp_replace({c}, '{breaks}', '{joiner}', 'g')"
    return f"lower(regexp_replace({joined}, '[^a-zA-Z{SPACES}]+', '', 'g'))"


def id_hash(key: str, purpose: str = "sample") -> str:
    return f"('0x' || substr(md5('{purpose}:13:' || {key}), 1, 8))::BIGINT"


def pad(c: str, width) -> str:
    return f"rpad({c}, greatest(length({c}), {width})::INTEGER, ' ')"


FIRST_LINE = "split_part(text, chr(10), 1)"
SOURCE_NUMBER = "CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT)"
TEXT_LOCALITY = f"'city' || ({SOURCE_NUMBER} % 5)"

HOTELS = """
hotels AS (
  SELECT c_custkey AS offering_id, c_name AS name, n_name AS locality, r_name AS region,
         c_mktsegment AS street_address, '/hotel/' || c_custkey AS url,
         CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 2000) END AS hotel_class
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

RATED = HOTELS + """,
rated AS (
  SELECT h.*, l_orderkey, l_linenumber, ceil(l_quantity / 10) AS overall,
         CASE WHEN l_returnflag <> 'N' THEN ceil(l_quantity / 10) END AS service,
         CASE WHEN l_linestatus = 'F' THEN floor(l_tax * 50) + 1 END AS cleanliness,
         CAST(least(l_linenumber, 5) AS DOUBLE) AS location,
         floor(l_discount * 40) + 1 AS value,
         6 - ceil(l_quantity / 10) AS rooms,
         CASE WHEN ceil(l_quantity / 10) >= 3 THEN 'positive' ELSE 'negative' END AS review
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN hotels h ON o_custkey = offering_id)"""

IN_CITY = RATED + f""",
city AS (SELECT * FROM rated WHERE locality = '{CITY}')"""

TOP5 = IN_CITY + """,
totals AS (
  SELECT name, count(*) AS review_count, count(*) FILTER (review = 'positive') AS positive_counts
  FROM city GROUP BY name),
top AS (
  SELECT *, row_number() OVER (ORDER BY positive_counts DESC, name) AS rank
  FROM totals ORDER BY rank LIMIT 5)"""


def category_totals(source: str, category: str, key: str, mode: str, label: str = "review") -> str:
    filled = f"coalesce({category}, CASE {label} WHEN 'positive' THEN 4.0 WHEN 'negative' THEN 2.0 END)"
    return f"""
filled AS (SELECT {key}, {label} AS label, CAST({filled} AS DOUBLE) AS score FROM {source}),
scores AS (
  SELECT {key}, count(*) AS review_count, count(*) FILTER (label = 'positive') AS positive_counts,
         {'max' if mode == 'max' else 'avg'}(score) AS score
  FROM filled GROUP BY {key}),
weighted AS (
  SELECT {key}, (review_count * score + 10 * (SELECT avg(score) FROM filled)) / (review_count + 10) AS weighted_avg,
         review_count, positive_counts
  FROM scores)"""


def top_category(head: str, source: str, category: str, mode: str = "max", label: str = "review") -> str:
    return f"""{head}, {category_totals(source, category, 'name', mode, label)}
SELECT name, round(weighted_avg, 6) AS weighted_avg, review_count, positive_counts,
       row_number() OVER (ORDER BY weighted_avg DESC NULLS LAST, positive_counts DESC, name) AS rank
FROM weighted ORDER BY rank LIMIT 10"""


TEXTS = f"""
texts AS (
  SELECT doc_id AS comment_id, source AS name, {TEXT_LOCALITY} AS locality,
         {clean(FIRST_LINE)} || ' ' || {clean('text')} AS review_text,
         CASE quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END AS review,
         CASE WHEN toxic = 0 THEN 4.0 END AS service
  FROM documents LEFT JOIN labels USING (doc_id))"""


def balanced(source: str) -> str:
    return f"""
fraction AS (
  SELECT least(1.0, count(*) FILTER (review = 'negative') / count(*) + CAST(0.1 AS DOUBLE)) AS f FROM {source}),
balanced AS (
  SELECT * FROM {source}
  WHERE review = 'negative' OR {id_hash('comment_id')} < (SELECT f FROM fraction) * 4294967296)"""


def tokens(name: str, source: str) -> str:
    """Split on single white space; trailing empty words go, stop words go."""
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT comment_id, review, unnest(string_split_regex(regexp_replace(review_text, '\\s+$', ''), '\\s')) AS term
    FROM {source} WHERE NOT regexp_full_match(review_text, '\\s+'))
  WHERE term NOT IN ({quoted(ENGLISH_STOP_WORDS)}))"""


NB = TEXTS + f""",
others AS (SELECT * FROM texts WHERE locality IS DISTINCT FROM '{TEXT_CITY}' AND review IS NOT NULL),
held_out AS (SELECT * FROM texts WHERE locality = '{TEXT_CITY}' AND review_text IS NOT NULL), {balanced('others')},
{tokens('words', 'balanced')}"""

# The models know the most frequent terms only.
CUT = f"ORDER BY count(*) DESC, term LIMIT {sentiment.VOCAB_SIZE}"


def nb_weights(words: str, cut: str) -> str:
    return f"""
vocabulary AS (
  SELECT term, count(*) FILTER (review = 'positive') AS pos, count(*) FILTER (review = 'negative') AS neg
  FROM {words} GROUP BY term {cut}),
sums AS (SELECT sum(pos) AS all_pos, sum(neg) AS all_neg, count(*) AS size FROM vocabulary),
weights AS (
  SELECT term, ln(pos + 1) - ln(all_pos + size) AS positive, ln(neg + 1) - ln(all_neg + size) AS negative
  FROM vocabulary, sums)"""


def nb_scored(learned: str, asked: str) -> str:
    """Every row of ``asked`` scored by the weights, with priors from ``learned``."""
    return f"""
priors AS (
  SELECT ln(count(*) FILTER (review = 'positive') + 1) - ln(count(*) + 2) AS positive,
         ln(count(*) FILTER (review = 'negative') + 1) - ln(count(*) + 2) AS negative
  FROM {learned}),
{tokens('asked_words', asked)},
sums_by_id AS (
  SELECT comment_id, sum(positive) AS positive, sum(negative) AS negative
  FROM asked_words JOIN weights USING (term) GROUP BY comment_id),
scored AS (
  SELECT h.*, p.positive + coalesce(s.positive, 0) AS log_positive, p.negative + coalesce(s.negative, 0) AS log_negative,
         CASE WHEN log_positive >= log_negative THEN 'positive' ELSE 'negative' END AS predicted
  FROM {asked} h CROSS JOIN priors p LEFT JOIN sums_by_id s USING (comment_id))"""


NB_SCORED = f"{NB}, {nb_weights('words', CUT)}, {nb_scored('balanced', 'held_out')}"
NB_PARTS = f"""{NB},
parts AS (
  SELECT comment_id, review, review_text,
         CASE WHEN {id_hash('comment_id', 'split')} < CAST(0.8 AS DOUBLE) * 4294967296 THEN 'training' ELSE 'validation' END AS data
  FROM balanced
  UNION ALL SELECT comment_id, review, review_text, 'prediction' FROM held_out WHERE review IS NOT NULL),
train AS (SELECT * FROM parts WHERE data = 'training'),
train_words AS (SELECT w.* FROM words w SEMI JOIN train USING (comment_id)),
{nb_weights('train_words', CUT)}, {nb_scored('train', 'parts')}"""

PROFILES = vocabulary.default_profiles()
KNOWN = sorted(set().union(*PROFILES.values()))
QUOTED_LANGS = ", ".join(f'"{x}"' for x in PROFILES)
BEST_HITS = f"greatest({QUOTED_LANGS})"
LANGUAGES = f"""
tokens AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS word FROM documents),
hits AS (
  SELECT doc_id, {', '.join(f'count(*) FILTER (word IN ({quoted(ws)})) AS "{lang}"' for lang, ws in PROFILES.items())},
         count(*) FILTER (word IN ({quoted(KNOWN)})) AS known
  FROM tokens GROUP BY doc_id),
detected AS (
  SELECT doc_id, CASE
    WHEN {BEST_HITS} <= 0.5 * known OR len(list_filter([{QUOTED_LANGS}], lambda h: h = {BEST_HITS})) > 1 THEN NULL
    {' '.join(f"""WHEN "{x}" = {BEST_HITS} THEN '{x}'""" for x in PROFILES)}
    END AS language
  FROM hits)"""

TITLE_LANGUAGE = f"""
tokens AS (
  SELECT lang, unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS word FROM documents
  WHERE lang IS NOT NULL AND {id_hash('doc_id', 'split')} < CAST(0.8 AS DOUBLE) * 4294967296),
word_counts AS (SELECT lang, word, count(*) AS n FROM tokens WHERE word <> '' GROUP BY ALL),
cut AS (SELECT lang, n, unnest(list_transform(range(1, length(word) + 1), lambda i: substr(' ' || word || ' ', i, 3))) AS gram FROM word_counts),
gram_counts AS (SELECT lang, gram, sum(n) AS n FROM cut GROUP BY ALL),
totals AS (SELECT lang, sum(n) + (SELECT count(DISTINCT gram) FROM gram_counts) AS total FROM gram_counts GROUP BY lang),
titles AS (SELECT doc_id, unnest(string_split_regex(lower({FIRST_LINE}), '[^\\p{{L}}]+')) AS word FROM documents),
asked AS (SELECT doc_id, unnest(list_transform(range(1, length(word) + 1), lambda i: substr(' ' || word || ' ', i, 3))) AS gram
          FROM titles WHERE word <> ''),
scores AS (
  SELECT doc_id, t.lang, sum(ln(coalesce(g.n, 0) + 1) - ln(total)) AS score
  FROM asked CROSS JOIN totals t LEFT JOIN gram_counts g ON g.lang = t.lang AND g.gram = asked.gram GROUP BY ALL),
best AS (SELECT doc_id, max(score) AS top, max_by(lang, score) AS language FROM scores GROUP BY doc_id),
sure AS (
  SELECT doc_id, CASE WHEN 1 / sum(exp(score - top)) > 0.5 THEN any_value(language) END AS language
  FROM scores JOIN best USING (doc_id) GROUP BY doc_id)"""

CLOUD_STOP = quoted(vocabulary.CLOUD_STOP_WORDS)
WORD_LIST = r"""
list_filter(
  list_transform(regexp_extract_all(lower(text), '[\p{L}\p{N}_][\p{L}\p{N}_'']*'),
                 lambda w: regexp_replace(w, '''s$', '')),
  lambda w: NOT regexp_full_match(w, '\p{N}+'))"""
WORDS = f"""
lists AS (SELECT doc_id, source, lang, {WORD_LIST} AS ws FROM documents),
words AS (SELECT doc_id, source, lang, unnest(ws) AS word FROM lists),
kept AS (SELECT * FROM words WHERE word NOT IN ({CLOUD_STOP}))"""


BEST_SOURCES = """
best AS (
  SELECT source FROM documents JOIN labels USING (doc_id)
  GROUP BY source ORDER BY count(*) FILTER (quality = 1) DESC, source LIMIT 5)"""


def stems(name: str, source: str, by: str = "") -> str:
    """(word, form, n): every word, the word it counts under, that form's count."""
    keys = f"{by}, " if by else ""
    partition = f"PARTITION BY {by}, stem" if by else "PARTITION BY stem"
    return f"""
{name}_stems AS (
  SELECT *, CASE WHEN word LIKE '%s' AND word NOT LIKE '%ss' THEN substr(word, 1, length(word) - 1) ELSE word END AS stem
  FROM {source}),
{name} AS (
  SELECT {keys}word, min(word) OVER ({partition}) AS form,
         CAST(sum(n) OVER ({partition}) AS BIGINT) AS n
  FROM {name}_stems)"""


def pairs(by: str = "", lists: str = WORDS) -> str:
    """Counts of single words and pairs, their forms and the pairs' scores."""
    keys = f"{by}, " if by else ""
    using = f"USING ({by}, word1)", f"USING ({by}, word2)"
    if not by:
        using = "USING (word1)", "USING (word2)"
    all_words = f"JOIN (SELECT {by}, sum(n) AS t FROM singles GROUP BY {by}) USING ({by})" if by else \
        "CROSS JOIN (SELECT sum(n) AS t FROM singles)"

    def log_l(k, m, x):
        return f"({k} * ln(greatest({x}, 1e-10)) + ({m} - {k}) * ln(greatest(1 - {x}, 1e-10)))"

    p, p1, p2 = "(n2 / t)", "(n / n1)", "((n2 - n) / (t - n1))"
    score = (f"-2 * ({log_l('n', 'n1', p)} + {log_l('(n2 - n)', '(t - n1)', p)}"
             f" - {log_l('n', 'n1', p1)} - {log_l('(n2 - n)', '(t - n1)', p2)})")
    return f"""{lists},
singles AS (SELECT {keys}word, count(*) AS n FROM kept GROUP BY {keys}word),
{stems('forms', 'singles', by)},
neighbours AS (SELECT {keys}unnest(ws[1:len(ws) - 1]) AS a, unnest(ws[2:len(ws)]) AS b FROM lists),
pair_counts AS (
  SELECT {keys}a || ' ' || b AS word, count(*) AS n FROM neighbours
  WHERE a NOT IN ({CLOUD_STOP}) AND b NOT IN ({CLOUD_STOP}) GROUP BY {keys}word),
{stems('pair_forms', 'pair_counts', by)},
pair_words AS (
  SELECT DISTINCT {keys}form AS word, n, split_part(form, ' ', 1) AS word1, split_part(form, ' ', 2) AS word2
  FROM pair_forms),
joined AS (
  SELECT {keys}p.word, p.n, f1.form AS form1, f1.n AS n1, f2.form AS form2, f2.n AS n2, CAST(t AS BIGINT) AS t
  FROM pair_words p
  JOIN (SELECT {keys}word AS word1, form, n FROM forms) f1 {using[0]}
  JOIN (SELECT {keys}word AS word2, form, n FROM forms) f2 {using[1]}
  {all_words}),
scored AS (
  SELECT {keys}word, n, form1, form2, CASE WHEN t <= n1 OR t <= n2 THEN 0 ELSE {score} END AS score FROM joined),
terms AS (SELECT * FROM scored WHERE score > 30)"""


RULE = """
rule AS (
  SELECT source, lang, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS review,
         CASE WHEN toxic = 0 THEN 'positive' ELSE 'negative' END AS predicted
  FROM labels JOIN documents USING (doc_id))"""


def rule_metrics(by: str, head: str = RULE, source: str = "rule") -> str:
    def rate(part: str, whole: str) -> str:
        return f"coalesce({part} / nullif({whole}, 0), 0)"

    return f"""{head},
cells AS (
  SELECT {by}, count(*) AS total, count(*) FILTER (review = predicted) AS hit,
         count(*) FILTER (review = 'positive' AND predicted = 'positive') AS tp,
         count(*) FILTER (predicted = 'positive') AS pred, count(*) FILTER (review = 'positive') AS actual
  FROM {source} GROUP BY {by}),
found AS (
  SELECT {by}, {rate('hit', 'total')} AS accuracy, {rate('tp', 'pred')} AS precision, {rate('tp', 'actual')} AS recall,
         {rate('2 * tp', '(pred + actual)')} AS f1, {rate('(pred - tp)', '(total - actual)')} AS fpr
  FROM cells)"""


def report(head: str, top: str, score_title: str | None) -> str:
    """Header, rule and rows of a fixed-width report over the CTE ``top``."""
    middle = f" || ' ' || {pad(f'''{score_title!r}''', 22)}" if score_title else ""
    value = " || ' ' || " + pad("printf('%.2f', weighted_avg)", 22) if score_title else ""
    total = "'Total Count'" if score_title else "'Total Reviews'"
    return f"""{head},
width AS (SELECT max(length(name)) AS w FROM {top})
SELECT CAST(0 AS INTEGER) AS line_no, {pad("'Rank'", 5)} || ' ' || {pad("'Hotel Name'", 'w')}{middle}
       || ' ' || {pad(total, 12)} || ' ' || {pad("'Positive Reviews'", 16)} AS line FROM width
UNION ALL SELECT CAST(1 AS INTEGER), repeat('-', w + 50) FROM width
UNION ALL SELECT CAST(rank + 1 AS INTEGER), {pad('rank::VARCHAR', 5)} || ' ' || {pad('name', 'w')}{value}
       || ' ' || {pad('review_count::VARCHAR', 12)} || ' ' || {pad('positive_counts::VARCHAR', 16)} FROM {top}, width"""


CARDS = RATED + """,
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY l_orderkey, hotel_class) AS r,
         count(*) OVER (PARTITION BY name) AS review_count
  FROM rated),
cards AS (
  SELECT name, CASE WHEN hotel_class IS NULL OR hotel_class = 0 THEN 'Not Given' ELSE hotel_class::VARCHAR END
         AS hotel_class, street_address || ', ' || locality || ', ' || region AS address, url, review_count
  FROM firsts WHERE r = 1)"""

CITY_NAMES = " ".join(f"WHEN {n} THEN '{name}'" for n, name in labels.CITIES.items())
CATEGORY_NAMES = " ".join(f"WHEN {n} THEN '{name}'" for n, name in labels.CATEGORY_CHOICES.items())

ORDER_RATING = "least(floor(o_totalprice / 100000) + 1, 5)"
ORDER_GAP = f"CASE WHEN o_orderstatus <> 'P' THEN {ORDER_RATING} END"

ORACLE_SQL: dict[str, str] = {
    "merge_reviews_offerings": f"""WITH {HOTELS}
SELECT o_orderkey AS comment_id, offering_id, o_custkey::VARCHAR AS author_id, name, locality, region, street_address,
       hotel_class, url, o_orderpriority AS title, strftime(o_orderdate, '%B %Y') AS date_stayed,
       {ORDER_RATING} AS overall, {ORDER_GAP} AS service, false AS via_mobile
FROM orders JOIN hotels ON o_custkey = offering_id""",
    "flatten_struct": """SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS prop_k FROM events""",
    "cast_columns": """SELECT o_orderkey AS comment_id, CAST(o_custkey AS DOUBLE) AS offering_id FROM orders""",
    "keep_listed_ids": """SELECT doc_id AS comment_id, lang, source FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "join_predictions": """SELECT doc_id AS comment_id, source,
       CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS predicted_review_label
FROM documents JOIN labels USING (doc_id)""",
    "city_lookup": f"""SELECT n_nationkey::VARCHAR AS choice, true AS is_number, n_nationkey BETWEEN 1 AND 10 AS is_city,
       CASE n_nationkey {CITY_NAMES} END AS city, CASE n_nationkey {CATEGORY_NAMES} END AS category,
       lower(r_name) AS region_choice
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "label_review": f"""WITH {RATED} SELECT overall, review, count(*) AS n FROM rated GROUP BY overall, review""",
    "null_checks": f"""WITH {RATED} SELECT
{', '.join(f'bool_or({c} IS NULL) AS {c}_has_null' for c in ['overall', *CATEGORIES])} FROM rated""",
    "month_stayed": """SELECT strftime(l_shipdate, '%B') AS month_stayed, count(*) AS n FROM lineitem GROUP BY 1""",
    "clean_text": f"""SELECT doc_id AS comment_id, length({clean('text')}) AS clean_chars, md5({clean('text')}) AS clean_md5,
       md5(regexp_replace(text, '[^0-9a-zA-Z{SPACES}]+', '', 'g')) AS alnum_md5, md5({clean('text', ' ')}) AS spaced_md5
FROM documents""",
    "review_text": f"""WITH {TEXTS}
SELECT comment_id, review, locality, length(review_text) AS chars, md5(review_text) AS text_md5
FROM texts WHERE review IS NOT NULL""",
    "language_detect": f"""WITH {LANGUAGES} SELECT doc_id, lang, language FROM documents JOIN detected USING (doc_id)""",
    "english_only": f"""WITH {LANGUAGES} SELECT doc_id, source, lang FROM documents JOIN detected USING (doc_id)
WHERE language = 'en'""",
    "english_or_unknown": f"""WITH {LANGUAGES} SELECT doc_id, source, lang FROM documents JOIN detected USING (doc_id)
WHERE language = 'en' OR language IS NULL""",
    "clean_reviews": f"""WITH {LANGUAGES}
SELECT doc_id AS comment_id, source AS name, {TEXT_LOCALITY} AS locality, 'region' || ({SOURCE_NUMBER} % 3) AS region,
       CAST({SOURCE_NUMBER} % 6 AS DOUBLE) AS hotel_class, strftime(make_date(2012, doc_id % 12 + 1, 1), '%B') AS month_stayed,
       CAST(CASE quality WHEN 1 THEN 4 WHEN 0 THEN 2 END AS DOUBLE) AS overall,
       CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS review,
       md5({clean(FIRST_LINE)}) AS title_md5, md5({clean('text')}) AS text_md5
FROM documents JOIN detected USING (doc_id) LEFT JOIN labels USING (doc_id) WHERE language = 'en'""",
    "split_by_city": f"""WITH {RATED}
SELECT review, count(*) AS n, CASE WHEN locality = '{CITY}' THEN 'city' ELSE 'training' END AS side
FROM rated GROUP BY ALL""",
    "complement_null_city": f"""WITH {HOTELS}
SELECT offering_id, CASE WHEN hotel_class IS NOT NULL THEN locality END AS locality FROM hotels
WHERE hotel_class IS NULL OR locality <> '{CITY}'""",
    "sample_fraction": f"""WITH {TEXTS}, labelled AS (SELECT * FROM texts WHERE review IS NOT NULL), {balanced('labelled')}
SELECT round(f, 6) AS fraction, review, count(*) AS n FROM labelled, fraction GROUP BY ALL""",
    "balance_sampled": f"""WITH {TEXTS}, labelled AS (SELECT * FROM texts WHERE review IS NOT NULL), {balanced('labelled')}
SELECT comment_id, review FROM balanced""",
    "balance_exact": f"""WITH {TEXTS}, labelled AS (SELECT * FROM texts WHERE review IS NOT NULL),
ranks AS (SELECT comment_id, review, row_number() OVER (PARTITION BY review ORDER BY {id_hash('comment_id')}, comment_id) AS r
          FROM labelled),
smallest AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM labelled GROUP BY review))
SELECT comment_id, review FROM ranks, smallest WHERE r <= n""",
    "random_split": f"""SELECT doc_id AS comment_id,
       CASE WHEN {id_hash('doc_id', 'split')} < CAST(0.8 AS DOUBLE) * 4294967296 THEN 'train' ELSE 'test' END AS part
FROM documents""",
    "review_counts": f"""WITH {RATED} SELECT name, l_orderkey, l_linenumber, review AS predicted_review_label,
       count(*) OVER (PARTITION BY name) AS review_count FROM rated""",
    "positive_counts": f"""WITH {RATED} SELECT name, count(*) AS review_count,
       count(*) FILTER (review = 'positive') AS positive_counts FROM rated GROUP BY name""",
    "top5_hotels": f"""WITH {TOP5} SELECT * FROM top""",
    "impute_category": f"""WITH {RATED}
SELECT review AS predicted_review_label, service IS NULL AS was_missing, count(*) AS n,
       round(avg(coalesce(service, CASE review WHEN 'positive' THEN 4 ELSE 2 END)), 6) AS avg_service
FROM rated GROUP BY ALL""",
    "top10_category_max": "WITH " + top_category(IN_CITY, "city", "service", "max"),
    "top10_category_mean": "WITH " + top_category(IN_CITY, "city", "service", "mean"),
    **{f"top10_{c}": "WITH " + top_category(IN_CITY, "city", c) for c in CATEGORIES[1:]},
    "category_scores_all": f"""WITH {RATED}, {category_totals('rated', 'cleanliness', 'offering_id', 'mean')}
SELECT offering_id, round(weighted_avg, 6) AS weighted_avg, review_count, positive_counts FROM weighted""",
    "hotel_page": f"""WITH {IN_CITY}, names AS (SELECT DISTINCT name FROM city)
SELECT row_number() OVER (ORDER BY name) AS number, name FROM names ORDER BY number LIMIT 20 OFFSET 20""",
    "hotel_at": f"""WITH {IN_CITY}, names AS (SELECT DISTINCT name FROM city)
SELECT name FROM names ORDER BY name LIMIT 1 OFFSET 2""",
    "hotel_card": f"""WITH {CARDS} SELECT * FROM cards WHERE name = '{HOTEL}'""",
    "hotel_cards": f"""WITH {CARDS} SELECT * FROM cards""",
    "word_freq": f"""WITH {WORDS}
SELECT word, count(*) AS n FROM kept GROUP BY word ORDER BY n DESC, word LIMIT 1000""",
    "word_freq_by_source": f"""WITH {WORDS},
counted AS (SELECT source, word, count(*) AS n FROM kept GROUP BY source, word),
ranks AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, word) AS r FROM counted)
SELECT 'wordcloud_' || source AS file, word, n FROM ranks WHERE r <= 1000""",
    "word_plurals": f"""WITH {WORDS}, singles AS (SELECT lang, word, count(*) AS n FROM kept GROUP BY lang, word),
{stems('forms', 'singles', 'lang')}
SELECT DISTINCT lang, form AS word, n FROM forms""",
    "word_pairs": f"""WITH {pairs()} SELECT word, n, round(score, 4) AS score FROM terms""",
    "cloud_terms": f"""WITH {pairs('lang')},
counted AS (
  SELECT DISTINCT lang, form AS word, n FROM forms
  UNION ALL SELECT lang, form1, -n FROM terms UNION ALL SELECT lang, form2, -n FROM terms),
left_over AS (SELECT lang, word, CAST(sum(n) AS BIGINT) AS n FROM counted GROUP BY lang, word HAVING sum(n) > 0),
both_kinds AS (SELECT * FROM left_over UNION ALL SELECT lang, word, n FROM terms),
ranks AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM both_kinds)
SELECT lang, word, n FROM ranks WHERE r <= 1000""",
    "hotel_clouds": f"""WITH {pairs('source', WORDS.replace('FROM documents', "FROM documents WHERE source IN (SELECT source FROM best)")
                                   .replace('lists AS', BEST_SOURCES + ', lists AS'))},
counted AS (
  SELECT DISTINCT source, form AS word, n FROM forms
  UNION ALL SELECT source, form1, -n FROM terms UNION ALL SELECT source, form2, -n FROM terms),
left_over AS (SELECT source, word, CAST(sum(n) AS BIGINT) AS n FROM counted GROUP BY source, word HAVING sum(n) > 0),
both_kinds AS (SELECT * FROM left_over UNION ALL SELECT source, word, n FROM terms),
ranks AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, word) AS r FROM both_kinds)
SELECT source AS name, 'wordcloud-' || source AS file, word, n FROM ranks WHERE r <= 1000""",
    "report_lines": "WITH " + report(TOP5, "top", None),
    "category_report_lines": "WITH " + report(
        IN_CITY + "," + category_totals("city", "service", "name", "max") + """,
top AS (SELECT *, row_number() OVER (ORDER BY weighted_avg DESC NULLS LAST, positive_counts DESC, name) AS rank
        FROM weighted ORDER BY rank LIMIT 10)""", "top", "Avg Service Score"),
    "card_lines": f"""WITH {CARDS},
lines AS (SELECT name, [
    '', repeat('-', 50),
    '- ' || repeat(' ', (46 - length(name)) // 2) || name
         || repeat(' ', 46 - length(name) - (46 - length(name)) // 2) || ' -',
    repeat('-', 50), '', 'Hotel Class: ' || hotel_class || ' stars', 'Hotel Address: ' || address,
    'Link: ' || url, 'Number of Reviews: ' || review_count] AS l FROM cards)
SELECT name, CAST(i AS INTEGER) AS line_no, l[i + 1] AS line FROM lines, range(0, 9) r(i)""",
    "csv_round_trip": """SELECT doc_id, source, length(text) AS chars, md5(text) AS text_md5 FROM documents""",
    "json_round_trip": f"""SELECT o_orderkey AS comment_id, o_custkey AS offering_id, o_custkey::VARCHAR AS author_id,
       o_orderpriority AS title, strftime(o_orderdate, '%B %Y') AS date_stayed, {ORDER_RATING} AS overall,
       {ORDER_GAP} AS service FROM orders""",
    "city_table": f"""WITH {HOTELS} SELECT offering_id, name, hotel_class FROM hotels WHERE locality = '{CITY}'""",
    "nb_terms": f"""WITH {NB} SELECT term, review, count(*) AS n FROM words GROUP BY term, review""",
    "nb_train": f"""WITH {NB}, {nb_weights('words', '')}
SELECT term, round(positive, 6) AS positive, round(negative, 6) AS negative FROM weights""",
    "nb_predict": f"""WITH {NB_SCORED}
SELECT comment_id, review, CASE review WHEN 'positive' THEN 0.0::DOUBLE WHEN 'negative' THEN 1.0::DOUBLE END AS "reviewIndexed",
       CASE predicted WHEN 'positive' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS prediction,
       predicted AS predicted_review_label, round(log_positive, 4) AS log_positive, round(log_negative, 4) AS log_negative
FROM scored""",
    "nb_saved": f"""WITH {NB_SCORED} SELECT comment_id, predicted AS predicted_review_label FROM scored""",
    "top5_predicted": f"""WITH {NB_SCORED},
totals AS (SELECT name, count(*) AS review_count, count(*) FILTER (predicted = 'positive') AS positive_counts
           FROM scored GROUP BY name)
SELECT *, row_number() OVER (ORDER BY positive_counts DESC, name) AS rank FROM totals ORDER BY rank LIMIT 5""",
    "top10_predicted_service": "WITH " + top_category(NB_SCORED, "scored", "service", "max", "predicted"),
    "confusion_matrix": f"""WITH {RULE} SELECT review AS label, predicted AS prediction, count(*) AS n FROM rule GROUP BY ALL""",
    "class_metrics": f"""WITH {rule_metrics('lang')}
SELECT lang, round(accuracy, 6) AS "Accuracy", round(precision, 6) AS "Precision", round(recall, 6) AS "Recall",
       round(f1, 6) AS "F1Score", round(fpr, 6) AS "False Positive Rate", round(recall, 6) AS "True Positive Rate"
FROM found""",
    "accuracy_bars": f"""WITH {rule_metrics('source, lang')}
SELECT source AS "Model", round(avg(accuracy), 6) AS mean, round(stddev(accuracy), 6) AS sd FROM found GROUP BY source""",
    "accuracy_side_by_side": f"""WITH {rule_metrics('source, lang')}
SELECT source AS "Model", {', '.join(f"round(avg(accuracy) FILTER (lang = '{x}'), 6) AS {x}" for x in ['de', 'en', 'es', 'fr'])}
FROM found GROUP BY source""",
}
ORACLE_SQL["model_input_array"] = """
SELECT doc_id AS comment_id, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS review,
       source || ' ' || lang AS review_text
FROM labels JOIN documents USING (doc_id)"""
ORACLE_SQL["metrics_file"] = f"""WITH {rule_metrics('source, lang')}
SELECT source AS "Model", lang AS data, round(accuracy, 6) AS "Accuracy", round(f1, 6) AS "F1Score" FROM found"""
ORACLE_SQL["nb_compare"] = f"""WITH {rule_metrics('data', NB_PARTS, 'scored')}
SELECT 'Naive Bayes' AS "Model", data, round(accuracy, 6) AS "Accuracy", round(precision, 6) AS "Precision", round(recall, 6) AS "Recall",
       round(f1, 6) AS "F1Score", round(fpr, 6) AS "False Positive Rate", round(recall, 6) AS "True Positive Rate"
FROM found"""
ORACLE_SQL["title_language"] = f"""WITH {TITLE_LANGUAGE}
SELECT doc_id AS comment_id, lang, language FROM documents LEFT JOIN sure USING (doc_id)"""
ORACLE_SQL["title_clouds"] = f"""WITH {pairs('source', WORDS.replace('lower(text)', f'lower({clean(FIRST_LINE)})'))},
counted AS (
  SELECT DISTINCT source, form AS word, n FROM forms
  UNION ALL SELECT source, form1, -n FROM terms UNION ALL SELECT source, form2, -n FROM terms),
left_over AS (SELECT source, word, CAST(sum(n) AS BIGINT) AS n FROM counted GROUP BY source, word HAVING sum(n) > 0),
both_kinds AS (SELECT * FROM left_over UNION ALL SELECT source, word, n FROM terms),
ranks AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, word) AS r FROM both_kinds)
SELECT source, word, n FROM ranks WHERE r <= 1000"""
MANY_SCORED = NB_SCORED.replace("source AS name", "concat_ws('-', source, lang) AS name")
ORACLE_SQL["top5_of_many"] = f"""WITH {MANY_SCORED},
totals AS (SELECT name, count(*) AS review_count, count(*) FILTER (predicted = 'positive') AS positive_counts
           FROM scored GROUP BY name)
SELECT *, row_number() OVER (ORDER BY positive_counts DESC, name) AS rank FROM totals ORDER BY rank LIMIT 5"""
ORACLE_SQL["top10_of_many"] = "WITH " + top_category(MANY_SCORED, "scored", "service", "mean", "predicted")
ORACLE_SQL["csv_line_round_trip"] = ORACLE_SQL["csv_round_trip"]
ORACLE_SQL["top5_from_partials"] = ORACLE_SQL["top5_hotels"]
ORACLE_SQL["top10_from_partials"] = ORACLE_SQL["top10_category_mean"]
ORACLE_SQL["hotel_page_indexed"] = ORACLE_SQL["hotel_page"]
ORACLE_SQL["hotel_numbers"] = f"""WITH {IN_CITY}, names AS (SELECT DISTINCT name FROM city)
SELECT row_number() OVER (ORDER BY name) AS number, name FROM names"""
ORACLE_SQL["hotel_card_clustered"] = f"""WITH {CARDS} SELECT * FROM cards WHERE name = '{CITY_HOTEL}' AND address LIKE '%, {CITY}, %'"""
ORACLE_SQL["bucketed_join"] = f"""WITH {HOTELS}
SELECT o_orderkey AS comment_id, offering_id, name, locality, o_orderpriority AS title, {ORDER_RATING} AS overall, {ORDER_GAP} AS service
FROM orders JOIN hotels ON o_custkey = offering_id"""
ORACLE_SQL["report_file"] = f"SELECT line FROM ({ORACLE_SQL['report_lines']})"
