"""DuckDB SQL for the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op5_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS size
        FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
dw AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
h AS (SELECT doc_id, i, size, item_id FROM dw JOIN win USING (win, size)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

ORACLES["op6_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT html, max(page_id) AS keep FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN keep IS NULL OR keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM p LEFT JOIN k USING (html)
"""

# A shard is a hash prefix that fits while its parent does not.
ORACLES["op8_sharding"] = """
WITH d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
                  right(bin(('0x1' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT), 60) AS bits FROM documents),
p AS (SELECT depth, substr(bits, 1, depth) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
      FROM d, (SELECT unnest(range(0, 61)) AS depth) GROUP BY 1, 2),
fit AS (SELECT * FROM p WHERE shard_bytes <= 1048576 OR shard_docs = 1),
leaf AS (SELECT doc_id, n_bytes, min(depth) AS depth, bits FROM d JOIN fit ON fit.prefix = substr(d.bits, 1, fit.depth) GROUP BY doc_id, n_bytes, bits)
SELECT doc_id, n_bytes, prefix AS shard_id, leaf.depth::BIGINT AS depth, shard_bytes, shard_docs, shard_bytes > 1048576 AS oversize
FROM leaf JOIN fit ON fit.depth = leaf.depth AND fit.prefix = substr(leaf.bits, 1, leaf.depth)
"""

# References are medians over documents and over groups of sources, as the operator's.
ORACLES["op9_quality"] = r"""
WITH d AS (SELECT row_number() OVER () AS rk, doc_id, coalesce(lang, '') AS lang, ('0x' || substr(md5(coalesce(source, '')), 1, 8))::BIGINT % 64 AS g, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, length(t) AS n, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
             regexp_extract_all(lower(t), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F](?:[^\x20\x09-\x0D]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])?') AS cores FROM d),
m AS (SELECT *, [length(regexp_replace(t, '[^a-z]', '', 'g')), length(regexp_replace(t, '[^A-Z]', '', 'g')), length(regexp_replace(t, '[^0-9]', '', 'g')),
               length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')), length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')),
               length(regexp_replace(t, '[a-zA-Z0-9\x20\x09-\x0D#*$%&|<>]|[^\x00-\x7F]', '', 'g')), length(regexp_replace(t, '[\x00-\x7F]', '', 'g'))] AS c FROM w),
-- medians over documents, on a grid of 1/1000: classes 0 to 6, and 7, the tokens of punctuation alone
shares AS (SELECT lang, k, round(c[k + 1] / n::DOUBLE * 1000)::INT AS bin FROM m, (SELECT unnest(range(0, 7)) AS k) WHERE n >= 250
           UNION ALL SELECT lang, 7, round((1 - len(cores) / len(words)::DOUBLE) * 1000)::INT FROM m WHERE len(words) >= 40),
upto AS (SELECT lang, k, bin, sum(count(*)) OVER (PARTITION BY lang, k ORDER BY bin) AS below, sum(count(*)) OVER (PARTITION BY lang, k) AS all_of FROM shares GROUP BY lang, k, bin),
med AS (SELECT lang, k, min(bin) AS bin FROM upto WHERE 2 * below >= all_of GROUP BY lang, k),
cs AS (SELECT lang, list(bin::DOUBLE / whole ORDER BY k) AS cs FROM (SELECT *, sum(bin) OVER (PARTITION BY lang) AS whole FROM med WHERE k < 7) WHERE whole > 0 GROUP BY lang),
-- word shares: medians over the groups of sources of a language
each AS (SELECT lang, g, unnest(cores) AS word FROM m),
sizes AS (SELECT lang, g, count(*) AS k, sum(count(*)) OVER (PARTITION BY lang) AS all_of FROM each GROUP BY lang, g),
vote AS (SELECT lang, g, CASE WHEN k >= 2000 THEN g ELSE -1 END AS vote, k FROM sizes WHERE all_of >= 2000),
votes AS (SELECT lang, vote, sum(k) AS n, count(*) OVER (PARTITION BY lang) AS votes FROM vote GROUP BY lang, vote),
voted AS (SELECT lang, vote, word, count(*) / any_value(n)::DOUBLE AS share, any_value(votes) AS votes FROM each JOIN vote USING (lang, g) JOIN votes USING (lang, vote) GROUP BY lang, vote, word),
lists AS (SELECT lang, word, any_value(votes) AS votes, list(share ORDER BY share) AS s FROM voted WHERE share * 2000 >= 1 GROUP BY lang, word),
mid AS (SELECT lang, word, (coalesce(s[(votes - 1) // 2 - (votes - len(s)) + 1], 0) * ((votes - 1) // 2 >= votes - len(s))::INT + coalesce(s[votes // 2 - (votes - len(s)) + 1], 0) * (votes // 2 >= votes - len(s))::INT) / 2 AS share FROM lists),
top AS (SELECT * FROM (SELECT lang, word, share, row_number() OVER o AS r, sum(share) OVER (o ROWS UNBOUNDED PRECEDING) AS upto FROM mid WHERE share > 0 WINDOW o AS (PARTITION BY lang ORDER BY share DESC, word)) WHERE r <= 400 AND upto - share < 0.33),
refw AS (SELECT lang, word, share * (1 - coalesce(bin, 0) / 1000.0) AS share, coalesce(bin, 0) / 1000.0 AS bare FROM top LEFT JOIN (SELECT lang, bin FROM med WHERE k = 7) USING (lang)),
ref AS (SELECT lang, sum(share) AS named, greatest(0.0, 1 - any_value(bare) - sum(share)) AS rest, any_value(bare) AS bare FROM refw GROUP BY lang),
-- a class of share p in the text and q in the reference adds js(p, q)
known AS (SELECT rk, share AS q, count(*) AS k FROM (SELECT rk, lang, unnest(cores) AS word FROM m) JOIN refw USING (lang, word) GROUP BY rk, word, share),
seen AS (SELECT rk, sum(k) AS k, sum(p * log2(p / ((p + q) / 2)) + q * log2(q / ((p + q) / 2)) - q) AS js FROM (SELECT known.*, k / len(words)::DOUBLE AS p FROM known JOIN m USING (rk)) GROUP BY rk),
rest AS (SELECT m.rk, ref.named + coalesce(seen.js, 0) AS js, [(len(cores) - coalesce(seen.k, 0)) / len(words)::DOUBLE, (len(words) - len(cores)) / len(words)::DOUBLE] AS p, [ref.rest, ref.bare] AS q
         FROM m JOIN ref USING (lang) LEFT JOIN seen USING (rk) WHERE len(words) >= 40),
dist AS (SELECT m.*, wd, CASE WHEN n >= 250 THEN sqrt(greatest(0.0, list_sum(list_transform(list_zip(list_transform(c, lambda x: x / n::DOUBLE), cs), lambda z: (CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0.0 END) + (CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) ELSE 0.0 END))) / 2)) END AS cd
         FROM m LEFT JOIN (SELECT cs.* FROM cs JOIN ref USING (lang)) USING (lang)
         LEFT JOIN (SELECT rk, sqrt(greatest(0.0, (js + list_sum(list_transform(list_zip(p, q), lambda z: (CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0.0 END) + (CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) ELSE 0.0 END)))) / 2)) AS wd FROM rest) USING (rk)),
win AS (SELECT rk, i, array_to_string(words[i:i + 4], ' ') AS s FROM (SELECT rk, words, unnest(range(1, len(words) - 3)) AS i FROM m WHERE len(words) >= 5)),
rep AS (SELECT rk, count(DISTINCT p) AS n FROM (SELECT rk, unnest(range(i, i + 5)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY rk, s) AS k FROM win) WHERE k > 1) GROUP BY rk),
lin AS (SELECT rk, count(*) - count(DISTINCT l) AS n FROM (SELECT rk, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rk),
base AS (SELECT x.doc_id, len(words)::BIGINT AS n_words, (x.n - c[4])::BIGINT AS word_chars, c[5]::BIGINT AS n_symbols, coalesce(lin.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, cd, wd
         FROM dist x LEFT JOIN rep USING (rk) LEFT JOIN lin USING (rk))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT coalesce(cd > 0.32, false) AND NOT coalesce(wd > least(0.42, sqrt(0.04 + 9.0 / n_words)), false) AS kept
FROM base
"""


def _license_sql() -> str:
    """The licence scan with the operator's templates, phrases and limits: every place of a file where all key words of a template stand is judged."""
    from cadence.llm.licenses import PHRASES, TEMPLATES, _needed

    def words(text: str) -> str:
        return "[" + ", ".join(f"'{w}'" for w in text.split()) + "]"

    tpl = ", ".join(f"({t}, '{label}', {len(text.split())}, {len(_needed(text.split(), keys))})" for t, (label, text, keys) in enumerate(TEMPLATES))
    tw = ", ".join(f"({t}, {p}, '{w}', {str(p in dict(_needed(text.split(), keys))).lower()})" for t, (_, text, keys) in enumerate(TEMPLATES) for p, w in enumerate(text.split()))
    phrases = ", ".join(f"('{label}', {words(p)})" for p, label in PHRASES.items())
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rk, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
tpl(t, label, n_all, n_key) AS (VALUES {tpl}),
tw(t, p, word, is_key) AS (VALUES {tw}),
ph(label, words) AS (VALUES {phrases}),
pos AS (SELECT rk, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM d),
base AS (SELECT p.rk, ph.label, p.pos FROM pos p JOIN ph ON p.word = ph.words[1] JOIN d ON d.rk = p.rk WHERE d.w[p.pos + 1:p.pos + len(ph.words)] = ph.words),
lex AS (SELECT * FROM pos WHERE word IN (SELECT word FROM tw)),
keyed AS (SELECT rk, t, pos - p AS shift FROM lex JOIN (SELECT * FROM tw WHERE is_key) USING (word) JOIN tpl USING (t) GROUP BY rk, t, shift, n_key HAVING count(*) = n_key),
judged AS (SELECT rk, t, shift, label, count(*) / n_all::DOUBLE AS score FROM keyed JOIN tpl USING (t) JOIN tw USING (t) JOIN lex USING (rk, word) WHERE lex.pos = shift + tw.p GROUP BY rk, t, shift, label, n_all),
good AS (SELECT * FROM judged WHERE score >= 0.8),
b AS (SELECT rk, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY rk),
g AS (SELECT rk, max(score) AS score FROM good GROUP BY rk),
l AS (SELECT rk, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rk, label FROM base UNION ALL SELECT rk, label FROM good) GROUP BY rk)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels, coalesce(g.score, 0.0) AS score
FROM d LEFT JOIN b USING (rk) LEFT JOIN g USING (rk) LEFT JOIN l USING (rk)
"""


ORACLES["op10_licenses"] = _license_sql()

ORACLES["op13_ranked_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS rk, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
norm AS (SELECT rk, doc_id, 100 - 90 + ((90 * len(w) * n_docs) // n_terms) AS m FROM d, total WHERE len(w) > 0),
tf AS (SELECT rk, term, count(*)::BIGINT AS tf FROM (SELECT rk, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY rk, term),
wt AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term),
s AS (SELECT item_id, rk, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN wt USING (term) JOIN tf USING (term) JOIN norm USING (rk) GROUP BY item_id, rk)
SELECT item_id, r::INTEGER AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM s JOIN norm USING (rk) WHERE score > 0) WHERE r <= 10
"""
