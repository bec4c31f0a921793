"""The same results as SQL, for a second engine to check the queries against."""

from __future__ import annotations

from murmur import settings as S

# Written out here once more and not taken from the engine: a wrong pattern there must show.
# What cleaning removes, in this engine's dialect.
URLS = r"(http://|https://|www\.)[^\x09-\x0d\x1c-\x1f \x{85}\p{Z}]+"
HANDLES = r"@[_\p{N}\p{L}]+"
BEYOND_ASCII = "[[:^ascii:]]+"
MARKS = "[[:punct:]]+"
# Words that are cut in two.
CUT_WORDS = (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"))
# The public English stop words without those that have an apostrophe.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now d ll m o re ve y ain aren
couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn
"""

HOUR = 3600
MICROS = "'%Y-%m-%d %H:%M:%S.%f'"
SECONDS = "'%Y-%m-%d %H:%M:%S'"
ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"

STOP = ", ".join(f"'{w}'" for w in STOP_WORDS.split())
BLANKS = "'[\\t-\\r\\x1c-\\x20]+'"


def gsub(value: str, pattern: str, to: str) -> str:
    return f"regexp_replace({value}, '{pattern}', '{to}', 'g')"


def stripped(value: str) -> str:
    value = f"lower(coalesce({value}, ''))"
    for pattern, to in ((URLS, " "), (HANDLES, " "), (BEYOND_ASCII, " "), (MARKS, "")):
        value = gsub(value, pattern, to)
    for a, b in CUT_WORDS:
        value = gsub(value, rf"\b({a})({b})\b", r"\1 \2")
    return value


def tokens(value: str) -> str:
    return f"list_filter(regexp_split_to_array({stripped(value)}, {BLANKS}), lambda x: x <> '')"


def kept(value: str) -> str:
    return f"list_filter({tokens(value)}, lambda x: length(x) > 1 AND x NOT IN ({STOP}))"


def mean(micro: str, n: str, places: int) -> str:
    """Half-even mean of a sum in millionths."""
    step = 10 ** (6 - places)
    return (f"(round_even(({micro})::double / (nullif({n}, 0)::double * {step}::double), 0) "
            f"/ {10 ** places}::double + 0.0::double)")


def ratio(top: str, bottom: str, places: int) -> str:
    scale = 10 ** places
    return (f"coalesce(round_even(({top})::double * {scale}::double / nullif({bottom}, 0)::double, 0) "
            f"/ {scale}::double + 0.0::double, 0.0::double)")


def label(p: str) -> str:
    return f"CASE WHEN {p} >= 0.05 THEN 'Positive' WHEN {p} <= -0.05 THEN 'Negative' ELSE 'Neutral' END"


def confidence(p: str, s: str) -> str:
    """Half-even at four places of the exact binary value."""
    x = f"(abs({p}) + 0.15::double * {s})"
    product, split = f"({x} * 10000::double)", f"({x} * 134217729::double)"
    high = f"({split} - ({split} - {x}))"
    error = f"(({high} * 10000::double - {product}) + ({x} - {high}) * 10000::double)"
    side = f"CASE WHEN {error} > 0 THEN floor({product}) + 1 ELSE floor({product}) END"
    return (f"least(1.0::double, CASE WHEN {product} - floor({product}) = 0.5 AND {error} <> 0 THEN {side} "
            f"ELSE round_even({product}, 0) END / 10000::double)")


def scores(source: str, key: str, value: str, name: str) -> str:
    """CTE `name`: one scored row per key of `source`."""
    return f"""
{name}_words AS (SELECT {key}, unnest({kept(value)}) AS word FROM {source}),
{name}_sums AS (SELECT {key}, sum(p) AS p, sum(s) AS s, count(*) AS n
  FROM {name}_words JOIN lexicon USING (word) GROUP BY ALL),
{name}_means AS (SELECT {', '.join('d.' + k.strip() for k in key.split(','))},
  coalesce({mean('p', 'n', 4)}, 0.0::double) AS polarity,
  coalesce({mean('s', 'n', 4)}, 0.0::double) AS subjectivity
  FROM {source} d LEFT JOIN {name}_sums USING ({key})),
{name} AS (SELECT *, {label('polarity')} AS sentiment, {confidence('polarity', 'subjectivity')} AS confidence
  FROM {name}_means)"""


LEXICON = f"""
lexicon_words AS (SELECT DISTINCT unnest({kept('text')}) AS word FROM benchmark),
lexicon_drawn AS (SELECT word, ('0x' || substr(md5(word), 1, 4))::bigint AS h FROM lexicon_words),
lexicon AS (SELECT word, (h % 201 - 100) * 10000 AS p, (h % 101) * 10000 AS s FROM lexicon_drawn)"""
SCORED = LEXICON + "," + scores("documents", "doc_id", "text", "scored")
EVENTS = """
ev AS (SELECT event_id AS mention_id, ts AS timestamp, event_type AS brand, user_id::varchar AS username,
  event_id % (SELECT count(*) FROM documents) AS doc_id, props, value FROM events)"""
MENTIONS = SCORED + "," + EVENTS + """,
m AS (SELECT ev.*, polarity, subjectivity, sentiment, confidence,
  round(polarity * 1000000)::bigint AS pm, round(subjectivity * 1000000)::bigint AS sm,
  round(confidence * 1000000)::bigint AS cm FROM ev JOIN scored USING (doc_id))"""


def z(value: str, n: str, total: str, squares: str) -> str:
    spread = f"({n} * {squares} - {total} * {total})"
    gap = f"({n} * {value} - {total})"
    return (f"CASE WHEN {n} < 3 THEN 0.0::double WHEN {spread} = 0 THEN CASE WHEN {gap} = 0 THEN 0.0::double "
            f"ELSE 5.0::double END ELSE {gap}::double / sqrt({spread}::double) END")


def window_ctes(seconds: int = HOUR, source: str = "m") -> str:
    last = "OVER (ORDER BY window_start ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
    return f""",
facts AS (SELECT time_bucket(INTERVAL {seconds} SECONDS, timestamp) AS window_start, brand, count(*) AS mentions,
  count(*) FILTER (sentiment = 'Negative') AS negatives, sum(pm)::bigint AS pm FROM {source} GROUP BY ALL),
metrics AS (SELECT window_start, sum(mentions)::bigint AS volume, {mean('sum(pm)', 'sum(mentions)', 6)} AS mean_polarity,
  sum(negatives)::double / sum(mentions)::double AS negative_ratio FROM facts GROUP BY ALL),
based AS (SELECT *, row_number() OVER (ORDER BY window_start) AS rank, count(*) {last} AS n,
  sum(volume) {last} AS vs, sum(volume * volume) {last} AS vq,
  avg(negative_ratio) {last} AS nm, stddev_pop(negative_ratio) {last} AS nd FROM metrics),
win AS (SELECT window_start, volume, mean_polarity, negative_ratio, rank, n, {z('volume', 'n', 'vs', 'vq')} AS volume_z,
  CASE WHEN n < 3 THEN 0.0::double WHEN nd < 1e-9 THEN CASE WHEN abs(negative_ratio - nm) < 1e-9 THEN 0.0::double
  ELSE 5.0::double END ELSE (negative_ratio - nm) / nd END AS negative_z FROM based),
grid AS (SELECT w.window_start, b.brand, coalesce(f.mentions, 0) AS mentions, w.rank
  FROM win w CROSS JOIN (SELECT DISTINCT brand FROM facts) b LEFT JOIN facts f
  ON f.window_start = w.window_start AND f.brand = b.brand),
brand_based AS (SELECT *, count(*) OVER h AS n, coalesce(sum(mentions) OVER h, 0) AS s,
  coalesce(sum(mentions * mentions) OVER h, 0) AS q FROM grid
  WINDOW h AS (PARTITION BY brand ORDER BY window_start ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)),
bz AS (SELECT window_start, brand, mentions, rank, n, {z('mentions', 'n', 's', 'q')} AS brand_z
  FROM brand_based WHERE mentions > 0),
alerts AS (
  SELECT 'window-volume-' || strftime(window_start, {ISO}) AS id, 'Tweet volume spike' AS title,
    CASE WHEN volume_z >= 4 THEN 'High' ELSE 'Medium' END AS severity,
    'Current window has ' || volume || ' mentions (' || printf('%.1f', round_even(volume_z, 1))
      || ' standard deviations above baseline).' AS reason,
    round_even(least(volume_z / 5, 1.0::double), 3) AS score, 'volume' AS metric, NULL::varchar AS brand,
    strftime(window_start, {ISO}) AS "window"
  FROM win WHERE rank >= 4 AND volume_z >= 2.5 AND volume >= 3
  UNION ALL
  SELECT 'window-negative-' || strftime(window_start, {ISO}), 'Negative sentiment surge',
    CASE WHEN negative_z >= 4 THEN 'High' ELSE 'Medium' END,
    'Negative share is ' || round_even(negative_ratio * 100, 0)::bigint || '% ('
      || printf('%.1f', round_even(negative_z, 1)) || ' standard deviations above baseline).',
    round_even(least(negative_z / 5, 1.0::double), 3), 'negative_ratio', NULL, strftime(window_start, {ISO})
  FROM win WHERE rank >= 4 AND negative_z >= 2.5 AND negative_ratio >= 0.5
  UNION ALL
  SELECT 'brand-' || brand || '-' || strftime(window_start, {ISO}), 'Unusual activity · ' || brand, 'Medium',
    mentions || ' mentions for ' || brand || ' landed in one window ('
      || printf('%.1f', round_even(brand_z, 1)) || ' standard deviations above baseline).',
    round_even(least(brand_z / 5, 1.0::double), 3), 'brand_volume', brand, strftime(window_start, {ISO})
  FROM bz WHERE rank >= 4 AND brand_z >= 2.5 AND mentions >= 3)"""


WINDOWS = MENTIONS + window_ctes()
ALERT_LOG = """
log AS (SELECT 'user-' || user_id AS alert_id, event_type AS title, props AS detail,
  CASE WHEN value >= 20 THEN 'High' ELSE 'Medium' END AS severity,
  CASE WHEN value >= 40 THEN 'Acknowledged' ELSE 'Open' END AS status, ts AS seen_at FROM events),
newest AS (SELECT alert_id, title, detail, severity, seen_at AS updated_at FROM log
  QUALIFY row_number() OVER (PARTITION BY alert_id ORDER BY seen_at DESC, title DESC, detail DESC, severity DESC) = 1),
oldest AS (SELECT alert_id, status, seen_at AS created_at FROM log
  QUALIFY row_number() OVER (PARTITION BY alert_id ORDER BY seen_at, status) = 1),
state AS (SELECT alert_id, title, detail, severity, status, created_at, updated_at FROM newest JOIN oldest USING (alert_id)),
moves AS (SELECT alert_id, CASE title WHEN 'click' THEN 'Acknowledged' ELSE 'Resolved' END AS status, seen_at FROM log WHERE title IN ('click', 'purchase')
  QUALIFY row_number() OVER (PARTITION BY alert_id ORDER BY seen_at DESC, title DESC) = 1)"""
STATE_COLUMNS = (f"alert_id, title, detail, severity, status, strftime(created_at, {MICROS}) AS created_at, "
                 f"strftime(updated_at, {MICROS}) AS updated_at")
LABELS = ("count(*) FILTER (sentiment = 'Positive') AS positive, count(*) FILTER (sentiment = 'Neutral') AS neutral, "
          "count(*) FILTER (sentiment = 'Negative') AS negative")
P_MEAN = mean("sum(pm)", "count(*)", 3)
KPI = f"kpi AS (SELECT count(*) AS total, {LABELS} FROM m)"
SHARES = ", ".join(f"{ratio(f'{n} * 100', 'total', 1)} AS {n}_pct, coalesce({n}::double / nullif(total, 0), 0.0::double) AS {n}_share"
                   for n in ("positive", "negative", "neutral"))
BUCKET = ("CASE WHEN polarity <= -0.5 THEN {0} WHEN polarity <= -0.05 THEN {1} WHEN polarity < 0.05 THEN {2} "
          "WHEN polarity < 0.5 THEN {3} ELSE {4} END")
BUCKET_NAME = BUCKET.format(*(f"'{b}'" for b in S.BUCKETS))
BUCKET_ORDER = BUCKET.format(1, 2, 3, 4, 5) + "::integer"
NEG_PCT = f"({ratio(LABELS.split(', ')[2].split(' AS ')[0] + ' * 100', 'count(*)', 0)})::bigint"
BY_BRAND = f"by_brand AS (SELECT brand, count(*) AS total, {P_MEAN} AS polarity, {NEG_PCT} AS negative FROM m GROUP BY ALL)"
TIMELINE = f"""timeline AS (SELECT strftime(timestamp, '%H:%M') AS time, {LABELS}, {P_MEAN} AS polarity FROM m GROUP BY ALL)"""
LISTS = """,
cur AS (SELECT id, title, reason AS detail, severity FROM alerts),
sto AS (SELECT CASE WHEN severity = 'High' THEN id ELSE 'old-' || id END AS id, title, detail, severity FROM cur),
ses AS (SELECT CASE WHEN title = 'Tweet volume spike' THEN id ELSE 'demo-' || id END AS id, title, detail, severity FROM cur)"""


def page_escape(value: str) -> str:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        value = f"replace({value}, '{char}', '{entity}')"
    return value


def per_second_limiter(failed: str, limit: int, seconds: int) -> str:
    """Exact sliding log, one attempt at a time; the state is the list of admitted seconds."""
    return f"""WITH RECURSIVE a AS (SELECT user_id::varchar AS key, floor(epoch(ts))::bigint AS second,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events WHERE {failed}),
walk(key, i, second, held, refused) AS (
  SELECT key, i, second, [second], 0 FROM a WHERE i = 1
  UNION ALL
  SELECT a.key, a.i, a.second,
    CASE WHEN len(list_filter(walk.held, lambda x: a.second - x < {seconds})) >= {limit}
      THEN list_filter(walk.held, lambda x: a.second - x < {seconds})
      ELSE list_append(list_filter(walk.held, lambda x: a.second - x < {seconds}), a.second) END,
    CASE WHEN len(list_filter(walk.held, lambda x: a.second - x < {seconds})) >= {limit} THEN 1 ELSE 0 END
  FROM walk JOIN a ON a.key = walk.key AND a.i = walk.i + 1)
SELECT key, second, count(*) AS attempts, sum(refused)::bigint AS refused FROM walk
GROUP BY ALL HAVING sum(refused) > 0"""


LOCKS = """WITH RECURSIVE a AS (SELECT user_id::varchar AS key, floor(epoch(ts))::bigint AS second,
  event_type <> 'signup' AS failed, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
walk(key, i, second, counter, until, locked) AS (
  SELECT key, i, second, CASE WHEN failed THEN 1 ELSE 0 END, -1::bigint, false FROM a WHERE i = 1
  UNION ALL
  SELECT a.key, a.i, a.second,
    CASE WHEN a.second < walk.until THEN walk.counter WHEN a.failed THEN walk.counter + 1 ELSE 0 END,
    CASE WHEN a.second < walk.until THEN walk.until WHEN a.failed AND walk.counter + 1 >= 5 THEN a.second + 86400 ELSE -1 END,
    a.second >= walk.until AND a.failed AND walk.counter + 1 >= 5
  FROM walk JOIN a ON a.key = walk.key AND a.i = walk.i + 1)
SELECT key, second AS locked_at, until AS locked_until, counter::bigint AS failures FROM walk WHERE locked"""


def step(value: str) -> str:
    return f"SELECT doc_id, {value} AS result FROM documents"


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()} {body}"


RAW = "SELECT doc_id::varchar AS tweet_id, lang AS entity, source AS sentiment_label, text AS tweet_text FROM documents"
TURNS = "SELECT * FROM conversations"
EVENT_SCORE = ("CASE event_type WHEN 'error' THEN -1.0 WHEN 'purchase' THEN 0.8 WHEN 'signup' THEN 0.5 "
               "WHEN 'view' THEN -0.02 ELSE 0.0 END::double")
EVENT_SUBJECTIVITY = ("CASE event_type WHEN 'error' THEN 0.5 WHEN 'purchase' THEN 0.9 WHEN 'signup' THEN 0.4 "
                      "WHEN 'view' THEN 0.1 ELSE 0.0 END::double")
STREAM = f"""
st AS (SELECT event_id, ts AS timestamp, event_type AS brand, {EVENT_SCORE} AS polarity, {EVENT_SUBJECTIVITY} AS subjectivity FROM events),
stream AS (SELECT *, {label('polarity')} AS sentiment, {confidence('polarity', 'subjectivity')} AS confidence FROM st)"""
def spiked(at: str) -> str:
    return MENTIONS + f""",
seeds AS (SELECT *, row_number() OVER (ORDER BY mention_id) - 1 AS row_id FROM m WHERE sentiment = 'Negative' ORDER BY mention_id LIMIT 60),
spike AS (SELECT t.i, s.* FROM range(60) t(i) JOIN seeds s ON t.i % (SELECT count(*) FROM seeds) = s.row_id),
with_spike AS (SELECT timestamp, brand, sentiment, polarity, pm FROM m UNION ALL
  SELECT TIMESTAMP '{at}', brand, sentiment, polarity, pm FROM spike)"""


SPIKED = spiked("2024-01-31 00:00:00")
def forest(latest: bool) -> str:
    """isolation (window_start, r, score) over metrics: of the last window, or of every one by those before it."""
    ctes = ["""
pts AS MATERIALIZED (SELECT row_number() OVER (ORDER BY window_start) AS r, window_start, volume::double AS f0, mean_polarity AS f1, negative_ratio AS f2 FROM metrics),
digests AS MATERIALIZED (SELECT t, r, ('0x' || substr(md5('31:' || t || ':' || r), 1, 13))::bigint AS d FROM range(100) trees(t), pts),
wanted AS (SELECT r, f0, f1, f2 FROM pts WHERE r >= 8 """ + ("AND r = (SELECT max(r) FROM pts)" if latest else "") + ")"]
    if latest:
        ctes.append("""
members AS (SELECT t, r AS i, NULL::bigint AS until FROM digests WHERE r < (SELECT max(r) FROM pts)
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY d, r) <= 256)""")
    else:
        ctes.append("""
members AS MATERIALIZED (SELECT t, a.r AS i, until FROM digests a LEFT JOIN (
  SELECT a.t, a.r, b.r AS until FROM digests a JOIN digests b ON a.t = b.t AND (b.d < a.d OR (b.d = a.d AND b.r < a.r))
  QUALIFY row_number() OVER (PARTITION BY a.t, a.r ORDER BY b.r) = 256) USING (t, r))""")
    ctes.append("""
p0 AS MATERIALIZED (SELECT w.r, t, i, p.f0, p.f1, p.f2 FROM wanted w JOIN members m ON m.i < w.r AND (until IS NULL OR until >= w.r) JOIN pts p ON p.r = m.i),
n0 AS (SELECT r, t, 1::bigint AS node FROM wanted, range(100) trees(t))""")
    draw = "('0x' || substr(md5('31:' || t || ':' || node || ':{}'), 1, 13))::bigint::double / 4503599627370496.0::double"
    leaves = []
    for k in range(9):
        ctes.append(f"""
s{k} AS MATERIALIZED (SELECT r, t, node, n, list_filter([CASE WHEN h0 > l0 THEN 0 END, CASE WHEN h1 > l1 THEN 1 END, CASE WHEN h2 > l2 THEN 2 END],
    lambda x: x IS NOT NULL) AS usable, [l0, l1, l2] AS low, [h0, h1, h2] AS high
  FROM n{k} JOIN (SELECT r, t, count(*) AS n, min(f0) AS l0, max(f0) AS h0, min(f1) AS l1, max(f1) AS h1, min(f2) AS l2, max(f2) AS h2
    FROM p{k} GROUP BY ALL) USING (r, t)),
g{k} AS MATERIALIZED (SELECT *, len(usable) > 0 AND n > 1 AND {k} < ceil(log2(greatest(2, least(256, r - 1)))) AS grows FROM s{k}),
c{k} AS MATERIALIZED (SELECT r, t, node, f, low[f + 1] + u * (high[f + 1] - low[f + 1]) AS cut, [f0, f1, f2][f + 1] AS x
  FROM (SELECT *, usable[floor({draw.format("f")} * len(usable))::int + 1] AS f, {draw.format("c")} AS u FROM g{k} WHERE grows) JOIN wanted USING (r)),
n{k + 1} AS (SELECT r, t, 2 * node + CASE WHEN x <= cut THEN 0 ELSE 1 END AS node FROM c{k}),
p{k + 1} AS MATERIALIZED (SELECT r, t, i, f0, f1, f2 FROM p{k} JOIN c{k} USING (r, t) WHERE ([f0, f1, f2][f + 1] <= cut) = (x <= cut))""")
        leaves.append(f"SELECT r, {k} AS depth, n FROM g{k} WHERE NOT grows")
    path = "CASE WHEN {0} <= 1 THEN 0.0 WHEN {0} = 2 THEN 1.0 ELSE 2 * (ln({0} - 1) + 0.5772156649015329) - 2 * ({0} - 1) / {0}::double END"
    ctes.append(f"""
depths AS (SELECT r, sum(depth + {path.format("n")}) AS total FROM ({" UNION ALL ".join(leaves)}) GROUP BY r),
isolation AS (SELECT window_start, r, coalesce(pow(2.0, -total / 100 / ({path.format("least(256, r - 1)")})) - 0.5, 0.0)::double AS score
  FROM pts LEFT JOIN depths USING (r) {"WHERE r = (SELECT max(r) FROM pts)" if latest else ""}),
flagged AS (SELECT 'window-isolation-' || strftime(window_start, {ISO}) AS id, 'Unusual sentiment pattern' AS title, 'Medium' AS severity,
  'Isolation Forest flagged an atypical combination of volume and sentiment metrics.' AS reason, round_even(least(score, 1.0::double), 3) AS score,
  'multivariate' AS metric, NULL::varchar AS brand, strftime(window_start, {ISO}) AS "window" FROM isolation WHERE score >= 0.08)""")
    return ",".join(ctes)


LATEST = f"""latest AS (SELECT strftime(max(window_start), {ISO}) AS "window" FROM win),
{forest(True).strip()},
found AS (SELECT * FROM alerts WHERE "window" = (SELECT "window" FROM latest) UNION ALL SELECT * FROM flagged)"""
TOKENS = f"words AS (SELECT doc_id, unnest({kept('text')}) AS word FROM documents)"
MINUTES = f"""minutes AS (SELECT unnest(generate_series(date_trunc('minute', min(timestamp)), date_trunc('minute', max(timestamp)), INTERVAL 1 MINUTE)) AS minute FROM m),
seen AS (SELECT date_trunc('minute', timestamp) AS minute, count(*) AS volume, {mean('sum(pm)', 'count(*)', 6)} AS avg_polarity FROM m GROUP BY ALL),
filled AS (SELECT strftime(minute, {SECONDS}) AS minute, coalesce(volume, 0) AS volume, avg_polarity FROM minutes LEFT JOIN seen USING (minute))"""
DISTRIBUTION = f"""dist AS (SELECT position, d.sentiment, coalesce(n, 0) AS n, {ratio('coalesce(n, 0) * 100', 'sum(coalesce(n, 0)) OVER ()', 1)} AS pct
  FROM (VALUES (1, 'Positive'), (2, 'Neutral'), (3, 'Negative')) d(position, sentiment)
  LEFT JOIN (SELECT sentiment, count(*) AS n FROM m GROUP BY ALL) c ON c.sentiment = d.sentiment)"""
RECENT = "(SELECT max(timestamp) FROM {0}) - INTERVAL {1}"

SQL = {
    "c1_text_or_empty": step("coalesce(nullif(text, ''), '')"),
    "c2_lowercase": step("lower(text)"),
    "c3_remove_urls": step(gsub("lower(text)", URLS, " ")),
    "c4_remove_mentions": step(gsub("lower(text)", HANDLES, " ")),
    "c5_remove_hashtag_symbols": step("replace(lower(text), '#', '')"),
    "c6_remove_emojis": step(gsub("lower(text)", BEYOND_ASCII, " ")),
    "c7_remove_punctuation": step(gsub("lower(text)", MARKS, "")),
    "c8_collapse_whitespace": step(f"trim(regexp_replace(lower(text), {BLANKS}, ' ', 'g'))"),
    "c9_tokenize": step(f"array_to_string({tokens('text')}, ' ')"),
    "c10_remove_stopwords": step(f"array_to_string({kept('text')}, ' ')"),
    "c11_clean_tweet": step(f"array_to_string({kept('text')}, ' ')"),
    "n1_lexicon_score": with_(SCORED, "SELECT doc_id, polarity, subjectivity FROM scored"),
    "n2_label_from_polarity": with_(SCORED, "SELECT doc_id, sentiment AS label FROM scored"),
    "n3_confidence": with_(SCORED, "SELECT doc_id, confidence FROM scored"),
    "n4_score_empty": with_(SCORED, "SELECT * FROM scored WHERE subjectivity = 0 AND confidence = 0"),
    "n5_score_struct": with_(LEXICON + "," + scores("conversations", "conv_id, turn", "text", "turns"),
                             f"SELECT t.*, role, text AS tweet, array_to_string({kept('text')}, ' ') AS clean_tweet "
                             "FROM turns t JOIN conversations USING (conv_id, turn)"),
    "n6_sentiment_score": with_(MENTIONS, f"SELECT round(({mean('sum(pm)', 'count(*)', 6)} + 1) / 2 * 100, 1) AS sentiment_score FROM m"),
    "n7_polarity_bucket": with_(SCORED, f"SELECT doc_id, {BUCKET_NAME} AS bucket, {BUCKET_ORDER} AS position FROM scored"),
    "n8_colours": with_(SCORED, """SELECT doc_id, CASE sentiment WHEN 'Positive' THEN '#27AE60' WHEN 'Negative' THEN '#E74C3C'
      WHEN 'Neutral' THEN '#95A5A6' ELSE '#BDC3C7' END AS label_colour,
      CASE WHEN polarity >= 0 THEN '#27AE60' ELSE '#E74C3C' END AS polarity_colour FROM scored"""),
    "f1_filter_brand": "SELECT event_id AS mention_id, event_type AS brand FROM events WHERE lower(event_type) = 'click'",
    "f2_filter_sentiment": with_(MENTIONS, "SELECT mention_id, sentiment FROM m WHERE sentiment = 'Negative'"),
    "f3_filter_search": with_(EVENTS, """SELECT mention_id, brand FROM ev JOIN documents USING (doc_id)
      WHERE contains(lower(text), '#') OR contains(lower(brand), '#')"""),
    "f3_index_search": with_(EVENTS, "SELECT mention_id, brand FROM ev JOIN documents USING (doc_id) WHERE contains(lower(text), 'apache license')"),
    "f4_filter_days": with_(EVENTS, f"SELECT mention_id, strftime(timestamp, {MICROS}) AS timestamp FROM ev WHERE timestamp >= {RECENT.format('ev', '7 DAYS')}"),
    "f5_filtered": with_(MENTIONS + """, hit AS (SELECT m.* FROM m JOIN documents USING (doc_id)
      WHERE sentiment = 'Negative' AND (contains(lower(text), '#') OR contains(lower(brand), '#')))""",
                         f"SELECT mention_id, brand, sentiment, polarity FROM hit WHERE timestamp >= {RECENT.format('hit', '7 DAYS')}"),
    "f6_drop_bad_timestamp": f"""SELECT event_id, strftime(t, {MICROS}) AS timestamp FROM (
      SELECT event_id, try_cast(unnest([ts::varchar, props]) AS timestamp) AS t FROM events) WHERE t IS NOT NULL""",
    "f7_slicer_values": with_(MENTIONS, "SELECT DISTINCT 'brand' AS slicer, brand AS value FROM m UNION SELECT DISTINCT 'sentiment', sentiment FROM m"),
    "f7_slicer": with_(MENTIONS, f"""SELECT mention_id, brand, sentiment FROM m JOIN documents USING (doc_id)
      WHERE sentiment IN ('Positive', 'Negative') AND brand IN ('click', 'view')
      AND timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'
      AND contains(array_to_string({kept('text')}, ' '), 'the')"""),
    "f8_brands_list": "SELECT DISTINCT event_type AS brand FROM events WHERE event_type <> 'Other'",
    "f9_spreadsheet_safe": """SELECT event_id, CASE WHEN regexp_matches(cell, '^[ \\t\\r\\n]*[=+\\-@]') THEN '''' || cell ELSE cell END AS cell
      FROM (SELECT event_id, (['=', '  +', chr(9) || '-', chr(13) || chr(10) || '@', '', 'a='])[event_id % 6 + 1] || event_type AS cell FROM events)""",
    "f10_tweet_hash": with_(EVENTS, f"SELECT mention_id, sha256(strftime(timestamp, {MICROS}) || '|' || text) AS tweet_hash FROM ev JOIN documents USING (doc_id)"),
    "f11_report_snippet": f"SELECT page_id, replace({page_escape('substr(html, 1, 300)')}, chr(10), ' ') AS snippet FROM pages",
    "f12_relative_age": """SELECT event_id AS mention_id, CASE WHEN min < 1 THEN 'now' WHEN min < 60 THEN min || 'm ago'
      ELSE (min // 60) || 'h ago' END AS age FROM (SELECT event_id,
      greatest(0, floor(epoch_us(TIMESTAMP '2024-01-30 12:00:00' - ts) / 60000000)::bigint) AS min FROM
      (SELECT event_id, ts FROM events))""",
    "a1_kpi_counts": with_(MENTIONS + "," + KPI, "SELECT * FROM kpi"),
    "a2_kpi_pct": with_(MENTIONS + "," + KPI, f"""SELECT *, printf('%.1f', round(positive_share * 100, 1)) || '%' AS positive_label,
      printf('%.1f', round(negative_share * 100, 1)) || '%' AS negative_label FROM (SELECT *, {SHARES} FROM kpi)"""),
    "a3_neutral_remainder": with_(MENTIONS + "," + KPI, f"""SELECT positive_pct, negative_pct,
      greatest(0.0::double, round(100 - positive_pct - negative_pct, 1)) AS neutral_rest_pct FROM (SELECT {SHARES} FROM kpi)"""),
    "a4_avg_scores": with_(MENTIONS, f"""SELECT {P_MEAN} AS avg_polarity, {mean('sum(sm)', 'count(*)', 6)} AS avg_subjectivity,
      {mean('sum(cm)', 'count(*)', 6)} AS avg_confidence FROM m"""),
    "a5_tweets_per_min": f"""SELECT total, {ratio('total', '30', 1)} AS tweets_per_min, {ratio('total * 60', 'seconds', 1)} AS observed_per_min
      FROM (SELECT count(*) AS total, floor(epoch(max(ts)))::bigint - floor(epoch(min(ts)))::bigint AS seconds FROM events)""",
    "a6_by_brand": with_(MENTIONS + "," + BY_BRAND, "SELECT * FROM by_brand ORDER BY total DESC, brand"),
    "a7_a8_brand_measures": with_(MENTIONS, f"""SELECT brand, positive::double / total AS positive_share, (positive - negative)::double / total AS net_sentiment
      FROM (SELECT brand, count(*) AS total, {LABELS} FROM m GROUP BY ALL)"""),
    "a9_brand_sentiment_mix": with_(MENTIONS, f"SELECT brand, {LABELS} FROM m GROUP BY ALL"),
    "a10_sentiment_distribution": with_(MENTIONS + "," + DISTRIBUTION, "SELECT * FROM dist"),
    "a11_sentiment_summary": with_(MENTIONS, f"""SELECT sentiment, count(*) AS total, {P_MEAN} AS avg_polarity,
      CASE sentiment WHEN 'Positive' THEN 100.0 ELSE 0.0 END::double AS positive_pct,
      CASE sentiment WHEN 'Negative' THEN 100.0 ELSE 0.0 END::double AS negative_pct FROM m GROUP BY ALL"""),
    "a12_bucket_histogram": with_(MENTIONS, f"SELECT {BUCKET_ORDER} AS position, {BUCKET_NAME} AS polarity_bucket, count(*) AS n FROM m GROUP BY ALL"),
    "a13_scatter_points": with_(MENTIONS, "SELECT sentiment, polarity, subjectivity, confidence, count(*) AS n FROM m GROUP BY ALL"),
    "a14_word_frequency": with_(TOKENS + "," + EVENTS, """SELECT word, sum(times)::bigint AS n FROM words JOIN
      (SELECT doc_id, count(*) AS times FROM ev GROUP BY ALL) USING (doc_id) GROUP BY ALL ORDER BY n DESC, word LIMIT 20"""),
    "a15_timeline_minute_of_day": with_(MENTIONS + "," + TIMELINE, "SELECT * FROM timeline"),
    "a16_resample_minute": with_(MENTIONS + "," + MINUTES, "SELECT * FROM filled"),
    "a17_trend_by_sentiment": with_(MENTIONS, f"SELECT strftime(date_trunc('hour', timestamp), {SECONDS}) AS window_start, sentiment, count(*) AS n FROM m GROUP BY ALL"),
    "a17_score_trend": with_(MENTIONS, f"""SELECT strftime(timestamp, {MICROS}) AS timestamp, {mean('sum(pm)', 'count(*)', 6)} AS avg_polarity,
      {mean('sum(sm)', 'count(*)', 6)} AS avg_subjectivity FROM m GROUP BY timestamp"""),
    "a18_tumbling_metrics": with_(WINDOWS, f"""SELECT strftime(window_start, {SECONDS}) AS window_start, volume, mean_polarity,
      round(negative_ratio, 6) AS negative_ratio, brands FROM metrics JOIN (SELECT window_start,
      string_agg(brand || '=' || mentions, ',' ORDER BY brand) AS brands FROM facts GROUP BY ALL) USING (window_start)"""),
    "a18_tumbling_minute": with_(MENTIONS + window_ctes(60), f"SELECT strftime(window_start, {SECONDS}) AS window_start, volume, mean_polarity, round(negative_ratio, 6) AS negative_ratio FROM metrics"),
    "a19_gauges": with_(ALERT_LOG, "SELECT (SELECT count(*) FROM events) AS records_loaded, count(*) FILTER (status = 'Open') AS open_alerts FROM state"),
    "a20_report_summary": with_(MENTIONS + "," + KPI, f"""SELECT 1 AS position, 'Mentions' AS metric, total::varchar AS value FROM kpi
      UNION ALL SELECT 2, 'Positive', positive::varchar FROM kpi UNION ALL SELECT 3, 'Neutral', neutral::varchar FROM kpi
      UNION ALL SELECT 4, 'Negative', negative::varchar FROM kpi UNION ALL SELECT 5, 'Average polarity', CASE WHEN sum(pm) < 0 AND {P_MEAN} = 0 THEN '-' ELSE '' END || printf('%.3f', {P_MEAN}) FROM m"""),
    "a21_latest_window_count": with_(EVENTS, f"SELECT count(*) AS n FROM ev WHERE timestamp >= {RECENT.format('ev', '3600 SECONDS')}"),
    "a22_latest_avg_polarity": with_(MENTIONS, f"SELECT {mean('sum(pm)', 'count(*)', 6)} AS rolling_avg_polarity FROM m WHERE timestamp >= {RECENT.format('m', '60 MINUTES')}"),
    "a22_rolling_avg_polarity": with_(MENTIONS, f"""SELECT strftime(to_timestamp(second) AT TIME ZONE 'UTC', {SECONDS}) AS second, n, {mean('p', 'n', 6)} AS rolling_avg_polarity FROM (
      SELECT DISTINCT second, count(*) OVER w AS n, sum(pm) OVER w AS p FROM (SELECT floor(epoch(timestamp))::bigint AS second, pm FROM m)
      WINDOW w AS (ORDER BY second RANGE BETWEEN 300 PRECEDING AND CURRENT ROW))"""),
    "a22_stream_sliding": with_(MENTIONS, f"""SELECT strftime(until, {SECONDS}) AS until, count(*) AS n, {mean('sum(pm)', 'count(*)', 6)} AS rolling_avg_polarity
      FROM (SELECT time_bucket(INTERVAL 60 SECONDS, timestamp) + INTERVAL 60 SECONDS * (k + 1) AS until, pm FROM m, range(5) t(k)) GROUP BY ALL"""),
    "w1_trailing_baseline": with_(WINDOWS, f"SELECT strftime(window_start, {SECONDS}) AS window_start, rank, n FROM win"),
    "w2_zscore": with_(WINDOWS, f"SELECT strftime(window_start, {SECONDS}) AS window_start, round(volume_z, 6) + 0.0::double AS volume_z, round(negative_z, 6) + 0.0::double AS negative_z FROM win"),
    "w2_zscore_gap_filled": with_(MENTIONS + window_ctes(300), f"""SELECT strftime(window_start, {SECONDS}) AS window_start, volume, round({z('volume', 'n', 's', 'q')}, 6) + 0.0::double AS volume_z
      FROM (SELECT *, count(*) OVER h AS n, sum(volume) OVER h AS s, sum(volume * volume) OVER h AS q FROM (
        SELECT g.window_start, coalesce(volume, 0) AS volume FROM (SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL 5 MINUTES)) AS window_start FROM metrics) g
        LEFT JOIN metrics USING (window_start)) WINDOW h AS (ORDER BY window_start ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))"""),
    "w3_min_history": with_(WINDOWS, f"SELECT strftime(window_start, {SECONDS}) AS window_start, rank >= 4 AS watched FROM win"),
    "w4_volume_spike": with_(WINDOWS, "SELECT * FROM alerts WHERE metric = 'volume'"),
    "w5_negative_surge": with_(WINDOWS, "SELECT * FROM alerts WHERE metric = 'negative_ratio'"),
    "w6_brand_zscore": with_(WINDOWS, f"SELECT strftime(window_start, {SECONDS}) AS window_start, brand, mentions, n, round(brand_z, 6) + 0.0::double AS brand_z FROM bz"),
    "w6_brand_volume": with_(WINDOWS, "SELECT * FROM alerts WHERE metric = 'brand_volume'"),
    "w7_isolation_flag": with_(SPIKED + window_ctes(HOUR, "with_spike"), f"""SELECT strftime(window_start, {SECONDS}) AS window_start, volume,
      mean_polarity, negative_ratio, true AS in_range, true AS flagged FROM metrics ORDER BY metrics.window_start DESC LIMIT 1"""),
    "w8_score_windows": with_(SPIKED + window_ctes(HOUR, "with_spike") + "," + LATEST, "SELECT * FROM found"),
    "w7_isolation_forest": with_(WINDOWS + "," + forest(True), f"""SELECT strftime(window_start, {SECONDS}) AS window_start, volume, mean_polarity, negative_ratio,
      round(score, 9) AS isolation_score FROM isolation JOIN metrics USING (window_start)"""),
    "w7_isolation_all": with_(WINDOWS + "," + forest(False), f"SELECT strftime(window_start, {SECONDS}) AS window_start, r AS rank, round(score, 9) AS isolation_score FROM isolation"),
    "w8_back_test": with_(WINDOWS + "," + forest(False), "SELECT * FROM alerts UNION ALL SELECT * FROM flagged"),
    "w9_brand_bar_norm": with_(MENTIONS + "," + BY_BRAND + ", top AS (SELECT * FROM by_brand ORDER BY total DESC, brand LIMIT 6)",
                               "SELECT *, round(greatest(5.0::double, abs(polarity) / greatest(0.1::double, max(abs(polarity)) OVER ()) * 100), 6) AS width FROM top"),
    "l1_page": with_(MENTIONS + ", p AS (SELECT * FROM m WHERE brand = 'click' ORDER BY timestamp DESC, mention_id DESC LIMIT 12 OFFSET 24)",
                     f"SELECT mention_id, strftime(timestamp, {MICROS}) AS timestamp, text AS tweet, sentiment FROM p JOIN documents USING (doc_id)"),
    "l1_page_after": with_(EVENTS, f"SELECT mention_id, strftime(timestamp, {MICROS}) AS timestamp FROM ev WHERE timestamp < TIMESTAMP '2024-01-15' ORDER BY ev.timestamp DESC, mention_id DESC LIMIT 12"),
    "l1_far_page": with_(EVENTS, f"SELECT mention_id, strftime(timestamp, {MICROS}) AS timestamp FROM ev ORDER BY ev.timestamp DESC, mention_id DESC LIMIT 12 OFFSET (SELECT count(*) // 2 // 12 * 12 FROM events)"),
    "l1_page_info": """SELECT count(*) FILTER (event_type = 'click') AS total, 3::bigint AS page,
      greatest(1, ceil(count(*) FILTER (event_type = 'click') / 12))::bigint AS pages, count(*) AS available_total FROM events""",
    "l2_latest_feed": with_(EVENTS + ", p AS (SELECT * FROM ev ORDER BY timestamp DESC, mention_id DESC LIMIT 100)",
                            f"SELECT mention_id, strftime(timestamp, {MICROS}) AS timestamp, brand, text AS tweet FROM p JOIN documents USING (doc_id)"),
    "l3_recent_30": with_(MENTIONS, "SELECT mention_id, sentiment, polarity FROM m ORDER BY timestamp DESC, mention_id DESC LIMIT 30"),
    "l4_top_brands": "SELECT event_type AS brand, count(*) AS total FROM events GROUP BY ALL ORDER BY total DESC, brand LIMIT 6",
    "l5_audit_recent": "SELECT event_id AS id, user_id::varchar AS user_id, event_type AS event, props AS detail, strftime(ts, " + MICROS + ") AS created_at FROM events ORDER BY id DESC LIMIT 500",
    "l6_alerts_recent": with_(ALERT_LOG, f"SELECT alert_id, title, status, strftime(updated_at, {MICROS}) AS updated_at FROM state ORDER BY state.updated_at DESC, alert_id DESC LIMIT 100"),
    "r1_negative_share_alert": with_(MENTIONS + "," + KPI, f"""SELECT 'negative-share' AS id, 'Elevated negative sentiment' AS title,
      ({ratio('negative * 100', 'total', 0)})::bigint || '% of the current stream is negative.' AS detail, 'High' AS severity FROM kpi WHERE negative > total * 0.3"""),
    "r2_alert_fold": with_(ALERT_LOG, f"SELECT {STATE_COLUMNS} FROM state"),
    "r2_alert_upsert": with_(ALERT_LOG, f"SELECT {STATE_COLUMNS} FROM state"),
    "r2_stored_alerts": with_(ALERT_LOG, f"SELECT {STATE_COLUMNS} FROM state"),
    "r3_alert_transition": with_(ALERT_LOG + """, moved AS (SELECT s.* REPLACE (coalesce(v.status, s.status) AS status,
      coalesce(v.seen_at, s.updated_at) AS updated_at) FROM state s LEFT JOIN moves v USING (alert_id))""", f"SELECT {STATE_COLUMNS} FROM moved"),
    "r3_stored_transitions": with_(ALERT_LOG + """, moved AS (SELECT s.* REPLACE (coalesce(v.status, s.status) AS status,
      coalesce(v.seen_at, s.updated_at) AS updated_at) FROM state s LEFT JOIN moves v USING (alert_id))""", f"SELECT {STATE_COLUMNS} FROM moved"),
    "r3_loose_statuses": with_(ALERT_LOG, f"""SELECT alert_id, status, strftime(seen_at, {MICROS}) AS at FROM moves
      WHERE alert_id NOT IN (SELECT alert_id FROM log WHERE seen_at < TIMESTAMP '2024-01-02')"""),
    "j1_u3_alert_status_overlay": with_(WINDOWS + LISTS, """SELECT cur.*, CASE WHEN id IN (SELECT id FROM ses) THEN 'Resolved'
      WHEN id IN (SELECT id FROM sto) THEN 'Acknowledged' WHEN title = 'Negative sentiment surge' THEN 'Resolved' ELSE 'Open' END AS status FROM cur"""),
    "j2_alert_anti": with_(WINDOWS + LISTS, "SELECT * FROM sto WHERE id NOT IN (SELECT id FROM cur)"),
    "u1_alerts_union": with_(WINDOWS + LISTS, """SELECT * FROM cur UNION ALL SELECT * FROM sto WHERE id NOT IN (SELECT id FROM cur)
      UNION ALL SELECT * FROM ses WHERE id NOT IN (SELECT id FROM cur UNION ALL SELECT id FROM sto)"""),
    "alerts_list": with_(SPIKED + window_ctes(HOUR, "with_spike") + "," + LATEST + "," + ALERT_LOG + f""",
      share AS (SELECT count(*) AS total, count(*) FILTER (sentiment = 'Negative') AS negative FROM with_spike),
      cur AS (SELECT 'negative-share' AS id, 'Elevated negative sentiment' AS title,
          ({ratio('negative * 100', 'total', 0)})::bigint || '% of the current stream is negative.' AS detail, 'High' AS severity, 'Now' AS time
        FROM share WHERE negative > total * 0.3
        UNION ALL SELECT id, title, reason, severity, replace("window"[1:16], 'T', ' ') FROM found)""",
      """SELECT *, CASE title WHEN 'Tweet volume spike' THEN 'Acknowledged' ELSE 'Open' END AS status FROM cur
      UNION ALL SELECT alert_id, title, detail, severity, strftime(coalesce(v.seen_at, s.updated_at), '%Y-%m-%d %H:%M'), coalesce(v.status, s.status)
        FROM state s LEFT JOIN moves v USING (alert_id)
      UNION ALL SELECT 'demo-' || (i + 1), 'Negative sentiment spike - ' || brand,
        'Demo anomaly injected into the local stream for dashboard review.', 'High', 'Now', 'Open' FROM spike"""),
    "j3_timeline_anomaly_marks": with_(WINDOWS + "," + TIMELINE, "SELECT t.*, a.id, a.severity FROM timeline t JOIN alerts a ON substr(a.\"window\", 12, 5) = t.time"),
    "j4_zero_fill": with_(WINDOWS + ", near AS (SELECT window_start FROM win ORDER BY window_start DESC LIMIT 30)",
                          """SELECT brand, sum(mentions)::bigint AS mentions, count(*) FILTER (mentions > 0) AS present,
      count(*) FILTER (mentions = 0) AS zero_windows FROM grid WHERE window_start IN (SELECT window_start FROM near)
      AND brand IN (SELECT brand FROM facts WHERE window_start IN (SELECT window_start FROM near)) GROUP BY ALL"""),
    "t4_j5_meta_lookup": """WITH src AS (SELECT trim(text) AS k, max_by(lang, doc_id) AS brand, max_by(source, doc_id) AS username FROM documents GROUP BY ALL),
      msg AS (SELECT doc_id AS tweet_id, text FROM documents UNION ALL SELECT -conv_id * 1000 - turn, text FROM conversations)
      SELECT tweet_id, coalesce(brand, 'Other') AS brand, coalesce(username, 'community') AS username FROM msg LEFT JOIN src ON trim(text) = k""",
    "j6_lexicon_join": with_(LEXICON + "," + TOKENS, "SELECT word, count(*) AS n, min(p) / 1000000::double AS polarity FROM words JOIN lexicon USING (word) GROUP BY ALL"),
    "j7_stopword_anti": f"SELECT lang, sum(len({tokens('text')}))::bigint AS tokens, sum(len({kept('text')}))::bigint AS kept FROM documents GROUP BY ALL",
    "u2_concat_parts": "SELECT count(*) AS n, sum(length(text))::bigint AS chars FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark)",
    "u4_distinct_brands": "SELECT DISTINCT event_type AS brand FROM events",
    "r4_dedup_insert": """SELECT sha256(text) AS tweet_hash, min(doc_id) AS doc_id, min_by(lang, doc_id) AS lang, min_by(source, doc_id) AS source
      FROM documents WHERE text NOT IN (SELECT text FROM benchmark) GROUP BY ALL""",
    "r5_fixed_window": """SELECT user_id::varchar AS key, floor(epoch(ts))::bigint // 86400 * 86400 AS window_second, count(*) AS attempts,
      count(*) - 3 AS refused FROM events GROUP BY ALL HAVING count(*) > 3""",
    "r5_sliding_all_attempts": """SELECT DISTINCT key, second, attempts, in_span FROM (SELECT *, count(*) OVER (PARTITION BY key ORDER BY second
      RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW) AS in_span, count(*) OVER (PARTITION BY key, second) AS attempts
      FROM (SELECT user_id::varchar AS key, floor(epoch(ts))::bigint AS second FROM events)) WHERE in_span > 3""",
    "r5_sliding_exact": per_second_limiter("true", 3, 86_400),
    "r6_login_burst": per_second_limiter("event_type = 'error'", 2, 432_000),
    "r7_lockout_intervals": LOCKS,
    "r5_stream": per_second_limiter("true", 3, 86_400),
    "r6_stream": per_second_limiter("event_type = 'error'", 2, 432_000),
    "r7_stream": LOCKS,
    "s2_csv_detect_headerless": RAW,
    "s2_csv_detect_header": RAW,
    "s2_csv_to_messages": """SELECT key, md5(t) AS digest, brand, 'community' AS username, '2024-01-01T00:00:00.000000+00:00' AS produced_at FROM (
      SELECT doc_id::varchar AS key, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t, max_by(lang, doc_id) OVER (PARTITION BY regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS brand
      FROM documents) WHERE t <> ''""",
    "s3_csv_folder": with_(MENTIONS, f"SELECT mention_id::varchar AS mention_id, strftime(timestamp, {MICROS}) AS timestamp, md5(text) AS digest, sentiment, polarity, confidence FROM m JOIN documents USING (doc_id)"),
    "s4_latest_snapshot": "SELECT doc_id, lang, source FROM documents WHERE doc_id % 3 = 2",
    "s5_normalise": """SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '2024-01-05 10:20:30' END AS timestamp, text AS tweet, role AS brand, 'community' AS username,
      upper(role[1]) || lower(role[2:]) AS sentiment, 0.0::double AS polarity, turn::double AS subjectivity, 0.0::double AS confidence FROM conversations WHERE text <> ''""",
    "s6_label_impute": f"""SELECT doc_id, strftime(TIMESTAMP '2024-02-01' - INTERVAL 1 MINUTE * (count(*) OVER () - row_number() OVER (ORDER BY doc_id)), {SECONDS}) AS timestamp,
      md5(text) AS digest, 'Other' AS brand, 'community' AS username, CASE WHEN toxic = 1 THEN 'Negative' WHEN quality = 1 THEN 'Positive' ELSE 'Neutral' END AS sentiment,
      CASE WHEN toxic = 1 THEN -0.42 WHEN quality = 1 THEN 0.42 ELSE 0 END::double AS polarity, 0.5::double AS subjectivity, 0.72::double AS confidence FROM labels JOIN documents USING (doc_id)""",
    "s7_history_latest": with_(EVENTS, f"SELECT mention_id, strftime(timestamp, {MICROS}) AS timestamp, brand FROM ev ORDER BY ev.timestamp DESC, mention_id DESC LIMIT 5000"),
    "s8_bi_csv": with_(MENTIONS, f"""SELECT strftime(timestamp, {MICROS}) AS timestamp, md5('a "quoted", ' || text) AS tweet,
      md5(array_to_string({kept('text')}, ' ')) AS clean_tweet, polarity, subjectivity, sentiment, confidence, brand,
      {BUCKET_NAME} AS polarity_bucket FROM m JOIN documents USING (doc_id)"""),
    "s9_fallback": "SELECT event_type AS brand, count(*) AS n FROM events GROUP BY ALL",
    "t1_parse_json_payload": with_(EVENTS, """SELECT mention_id::integer AS tweet_id, length(t)::integer AS chars, md5(t) AS digest,
      strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS produced_at, brand, username
      FROM (SELECT ev.*, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t FROM ev JOIN documents USING (doc_id)) WHERE t <> ''"""),
    "t1_malformed": "SELECT props AS json_value, count(*) AS n FROM events GROUP BY ALL",
    "t2_build_message": """SELECT item_id::varchar AS key, to_json({tweet_id: item_id, tweet_text: regexp_replace(text, '^\\s+|\\s+$', '', 'g'),
      produced_at: '2024-01-01T00:00:00.000000+00:00', brand: 'Other', username: 'community'})::varchar AS value FROM benchmark WHERE trim(text) <> ''""",
    "t3_drop_blank_text": """SELECT doc_id, count(*) AS lines, sum(length(t))::bigint AS chars FROM (
      SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))), '^\\s+|\\s+$', '', 'g') AS t FROM documents) WHERE t <> '' GROUP BY ALL""",
    "t5_limit_rows": """SELECT doc_id, length(t)::integer AS chars FROM (SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t
      FROM documents ORDER BY doc_id LIMIT 50) WHERE t <> ''""",
    "t6_replay_cyclic": with_(EVENTS, "SELECT lang, source, count(*) AS n, max(mention_id) AS last FROM ev JOIN documents USING (doc_id) GROUP BY ALL"),
    "t6_replay_stream": """SELECT lang, source, count(*) AS n, max(k) AS last FROM (SELECT event_id // 2 AS k FROM events WHERE event_id % 2 = 1 AND event_id // 2 < (SELECT 5 * count(*) // 2 FROM documents)) t
      JOIN documents ON doc_id = k % (SELECT count(*) FROM documents) GROUP BY ALL""",
    "t7_inject_spike": with_(SPIKED + window_ctes(HOUR, "with_spike"), f"SELECT * FROM alerts WHERE \"window\" = (SELECT strftime(max(window_start), {ISO}) FROM win)"),
    "t7_spike_alerts": with_(SPIKED, """SELECT 'demo-' || (i + 1) AS id, 'Negative sentiment spike - ' || brand AS title,
      'Demo anomaly injected into the local stream for dashboard review.' AS detail, 'High' AS severity, 'Open' AS status FROM spike"""),
    "t8_retain_latest_n": """SELECT event_id AS mention_id, event_type AS brand FROM events QUALIFY row_number() OVER (ORDER BY event_id DESC) <=
      (SELECT CASE WHEN count(*) <= 5000 THEN count(*) ELSE 4001 + (count(*) - 5001) % 1000 END FROM events)""",
    "k1_sink_csv_append": with_(MENTIONS, """SELECT mention_id::varchar AS tweet_id, md5(text) AS digest, brand, sentiment,
      polarity::varchar AS polarity, confidence::varchar AS confidence FROM m JOIN documents USING (doc_id)"""),
    "k2_console": "SELECT event_type AS brand, count(*) AS shown, sum(event_id)::bigint AS ids FROM events GROUP BY ALL",
    "k3_sink_history": with_(EVENTS, "SELECT brand, count(*) AS n, sum(length(text))::bigint AS chars FROM ev JOIN documents USING (doc_id) GROUP BY ALL"),
    "k4_sink_live_batch": with_(MENTIONS, """SELECT 0::bigint AS batch_id, true AS bounded, mention_id::integer AS tweet_id, md5(text) AS tweet,
      brand, sentiment, polarity FROM m JOIN documents USING (doc_id)"""),
    "st4_one_query_all_sinks": with_(MENTIONS + """, rows AS (SELECT text, CASE WHEN regexp_matches(text, '^[ \\t\\r\\n]*[=+\\-@]') THEN chr(39) || text ELSE text END AS safe,
        brand, username, sentiment, polarity, timestamp FROM m JOIN documents USING (doc_id)),
      sunk AS (SELECT 'mentions' AS sink, md5(text) AS digest, brand, username, sentiment, polarity FROM rows
        UNION ALL SELECT 'csv', md5(safe), brand, username, sentiment, polarity FROM rows
        UNION ALL SELECT 'history', md5(text), brand, username, sentiment, polarity FROM rows)""",
      "SELECT *, count(*) AS n FROM sunk GROUP BY ALL"),
    "st1_stream_tumbling": with_(WINDOWS, f"SELECT strftime(window_start, {SECONDS}) AS window_start, volume, mean_polarity, round(negative_ratio, 6) AS negative_ratio FROM metrics"),
    "st2_watermark_dedup": """SELECT chunk, event_type AS brand, count(*) AS n FROM events, (VALUES ('first'), ('again')) c(chunk) GROUP BY ALL
      UNION ALL SELECT 'gap', event_type, 2 FROM events WHERE event_id = 0""",
    "st3_stream_alerts": with_(spiked("2024-01-20 12:00:00") + window_ctes(HOUR, "with_spike") + "," + forest(False),
      "SELECT id AS alert_id, title, reason AS detail, severity, 'Open' AS status FROM (SELECT * FROM alerts UNION ALL SELECT * FROM flagged)"),
    "st2_late_rows": "SELECT count(*) FILTER (ts < TIMESTAMP '2024-01-11') AS late, 1::bigint AS batches FROM events",
    "k5_export_csv": with_(MENTIONS + ", k AS (SELECT m.*, text FROM m JOIN documents USING (doc_id) WHERE brand = 'click' AND sentiment = 'Negative')",
                           f"""SELECT strftime(timestamp, {MICROS}) AS timestamp, subjectivity::varchar AS subjectivity, CASE WHEN regexp_matches(text, '^[ \\t\\r\\n]*[=+\\-@]') THEN '''' || text ELSE text END AS tweet, brand, username, sentiment,
      polarity::varchar AS polarity, confidence::varchar AS confidence FROM k WHERE timestamp >= {RECENT.format('k', '30 DAYS')}"""),
    "k5_export_neutral": with_(MENTIONS + ", k AS (SELECT m.*, text FROM m JOIN documents USING (doc_id) WHERE sentiment = 'Neutral')",
                               f"""SELECT brand, username, md5(CASE WHEN regexp_matches(text, '^[ \\t\\r\\n]*[=+\\-@]') THEN chr(39) || text ELSE text END) AS digest,
      polarity::varchar AS polarity, subjectivity::varchar AS subjectivity, confidence::varchar AS confidence, strftime(timestamp, {MICROS}) AS timestamp
      FROM k WHERE timestamp >= {RECENT.format('k', '30 DAYS')}"""),
    "k6_chart_datasets": with_(MENTIONS + "," + DISTRIBUTION + "," + MINUTES + "," + TOKENS, """SELECT 'sentiment_distribution' AS chart, sentiment AS item, n FROM dist
      UNION ALL (SELECT 'word_frequency', word, sum(times)::bigint AS c FROM words JOIN (SELECT doc_id, count(*) AS times FROM ev GROUP BY ALL) USING (doc_id) GROUP BY ALL ORDER BY c DESC, word LIMIT 20)
      UNION ALL SELECT 'time_series', minute, volume FROM filled"""),
    "k7_report_rows": with_(MENTIONS + ", p AS (SELECT * FROM m ORDER BY timestamp DESC, mention_id DESC LIMIT 30)",
                            f"""SELECT mention_id, strftime(timestamp, {MICROS}) AS timestamp, brand, sentiment, printf('%.2f', round_even(polarity, 2)) AS polarity,
      replace({page_escape('substr(text, 1, 300)')}, chr(10), ' ') AS snippet FROM p JOIN documents USING (doc_id)"""),
    "k8_dashboard_bundle": with_(SPIKED + window_ctes(HOUR, "with_spike") + "," + LATEST + "," + ", ".join(
      cte.replace("FROM m", "FROM with_spike") for cte in (KPI, BY_BRAND, TIMELINE)) + "," + ALERT_LOG + f""",
      fig AS (SELECT total, positive, negative, neutral, {ratio('positive * 100', 'total', 1)} AS positive_pct, {ratio('negative * 100', 'total', 1)} AS negative_pct,
        (SELECT {P_MEAN} FROM with_spike) AS avg_polarity, {ratio('total', '30', 1)} AS tweets_per_min FROM kpi),
      gau AS (SELECT (SELECT count(*) FROM with_spike) AS available_total, count(*) FILTER (status = 'Open') AS active_alerts FROM state)""",
      """SELECT 'figures' AS section, '' AS item, metric, value FROM (UNPIVOT (SELECT COLUMNS(*)::double FROM fig) ON COLUMNS(*) INTO NAME metric VALUE value)
      UNION ALL SELECT 'brands', brand, metric, value FROM (UNPIVOT (SELECT brand, total::double AS total, polarity, negative::double AS negative FROM by_brand) ON total, polarity, negative INTO NAME metric VALUE value)
      UNION ALL SELECT 'timeline', time, metric, value FROM (UNPIVOT (SELECT time, positive::double AS positive, negative::double AS negative, neutral::double AS neutral, polarity FROM timeline) ON positive, negative, neutral, polarity INTO NAME metric VALUE value)
      UNION ALL SELECT 'anomalies', id, 'score', score FROM found
      UNION ALL SELECT 'brands_list', brand, 'listed', 1 FROM (SELECT DISTINCT brand FROM with_spike WHERE brand <> 'Other')
      UNION ALL SELECT 'gauges', '', metric, value FROM (UNPIVOT (SELECT COLUMNS(*)::double FROM gau) ON COLUMNS(*) INTO NAME metric VALUE value)"""),
    "k8_cube_by_batch": with_(MENTIONS, """SELECT brand, sentiment, count(DISTINCT date_trunc('minute', timestamp)) AS minutes, count(*) AS n,
      sum(pm)::bigint AS polarity_micro, count(confidence) AS scored FROM m GROUP BY ALL"""),
    "k9_sink_audit": "SELECT event_id AS id, user_id::varchar AS user_id, event_type AS event, 2000::integer AS chars FROM events",
}
