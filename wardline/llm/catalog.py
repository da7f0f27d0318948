"""Registered queries of the text operators, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import bpe, decontaminate, divergence, html_text, language_id, merkle, ngram_join, quality, secret_scan
from wardline.llm import substring_dedup, token_store, toxicity, url_filter
from wardline.llm.common import hash_remainder, read
from wardline.session import scratch_path


def op7_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-token-store")
    token_store.write_store(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return token_store.read_store(spark, path, with_ids=False)


TOXIC_FROM = 0.7


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = hash_remainder("doc_id", 3, 1)
    classifier = toxicity.fit(docs, labels.where(~held_out))
    scored = toxicity.score(docs, classifier)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted")
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_digests(read(spark, sf_dir, "documents"))


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(read(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = hash_remainder("doc_id", 4, 2)
    model = language_id.fit(docs.where(~held_out))
    found = language_id.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


# The rules of the result's definition.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second row, by its id, is folded in with the line breaks of its text deleted."""
    even = hash_remainder("doc_id", 2, 0)
    without_breaks = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.audit(read(spark, sf_dir, "documents"), without_breaks)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_secret_scan": op2_secret_scan,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_benchmark_leaks": op4_benchmark_leaks,
    "op5_ngram_join": op5_ngram_join,
    "op6_language_id": op6_language_id,
    "op7_bpe_encode_decode": op7_bpe_encode_decode,
    "op8_token_store": op8_token_store,
    "op9_quality_rules": op9_quality_rules,
    "op10_url_filter": op10_url_filter,
    "op11_source_divergence": op11_source_divergence,
    "op12_html_text": op12_html_text,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _host(url: str) -> str:
    return _LOWER.format(f"regexp_extract(coalesce({url}, ''), '^.*?://([^/?#]*)', 1, 's')")


def _path(url: str) -> str:
    return f"regexp_extract(coalesce({url}, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's')"


def _rule(host: str, path: str, of: int) -> str:
    cases = []
    for rule in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2])):
        text = (rule[0], rule[1] + rule[2])[of]
        cases.append(
            f"WHEN ({host} = '{rule[1]}' OR ends_with({host}, '.{rule[1]}')) AND starts_with({path}, '{rule[2]}') THEN '{text}'"
        )
    return f"CASE {' '.join(cases)} END"


def _attribute_sql(tag: str, name: str) -> str:
    pattern = _literal(url_filter.attribute(name))
    return "(" + " || ".join(f"coalesce(regexp_extract({tag}, {pattern}, {k}), '')" for k in (1, 2, 3)) + ")"


def _without_dots_sql(path: str) -> str:
    parts = f"string_split({path}, '/')"
    closed = f"(CASE WHEN regexp_matches({path}, '(^|/)[.][.]?$') THEN list_append({parts}, '') ELSE {parts} END)"
    step = "CASE WHEN x[1] = '.' THEN acc WHEN x[1] = '..' THEN acc[1:greatest(len(acc) - 1, 1)] ELSE list_concat(acc, x) END"
    return f"array_to_string(list_reduce([[x] FOR x IN {closed}], lambda acc, x: {step}), '/')"


def _absolute_sql(target: str, base: str) -> str:
    root = f"regexp_extract({base}, '^(.*?://[^/?#]*)', 1, 's')"
    path = f"('/' || regexp_replace({_path(base)}, '^/', ''))"
    folder = f"regexp_extract({path}, '^(.*/)', 1, 's')"
    own, rest = f"regexp_extract({target}, '^([^?#]*)', 1, 's')", f"regexp_extract({target}, '^[^?#]*(.*)', 1, 's')"
    return f"""CASE WHEN coalesce({target}, '') = '' THEN NULL
    WHEN regexp_matches({target}, '{url_filter.SCHEME}') THEN {target}
    WHEN starts_with({target}, '//') THEN regexp_extract({base}, '^(.*?)://', 1, 's') || ':' || {target}
    WHEN starts_with({target}, '/') THEN {root} || {_without_dots_sql(own)} || {rest}
    WHEN starts_with({target}, '?') THEN {root} || {path} || {target}
    WHEN starts_with({target}, '#') THEN {root} || {path} || regexp_extract({base}, '^[^?#]*([?][^#]*)', 1, 's') || {target}
    ELSE {root} || {_without_dots_sql(folder + " || " + own)} || {rest} END"""


def _decoded_sql(target: str) -> str:
    return f"trim(regexp_replace({target}, '{url_filter.AMPERSANDS}', '&', 'g'))"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_URL_SQL = f"""
WITH RECURSIVE tag AS (
  SELECT url, {_decoded_sql(_attribute_sql(f"regexp_extract(html, {_literal(url_filter.BASE_TAG)}, 0)", "href"))} AS shift,
    list_concat(
      [{_attribute_sql("t", "href")} FOR t IN regexp_extract_all(html, {_literal(url_filter.LINK_TAG)}, 0)
        IF regexp_matches({_attribute_sql("t", "rel")}, {_literal(url_filter.CANONICAL)})],
      [regexp_extract(t, {_literal(url_filter.REFRESH_TARGET)}, 1) FOR t IN regexp_extract_all(html, {_literal(url_filter.REFRESH_TAG)}, 0)]
    ) AS targets
  FROM pages WHERE url IS NOT NULL AND html IS NOT NULL
), based AS (
  SELECT url, coalesce({_absolute_sql("shift", "url")}, url) AS base, targets FROM tag
), found AS (
  SELECT url, base, {_decoded_sql("t")} AS t FROM (SELECT url, base, unnest(targets) AS t FROM based)
), target AS (
  SELECT url, {_absolute_sql("t", "base")} AS target FROM found WHERE t <> ''
), link AS (
  SELECT DISTINCT {_host("url")} || regexp_extract(url, '^.*?://[^/?#]*([^#]*)', 1, 's') AS a,
    {_host("target")} || regexp_extract(target, '^.*?://[^/?#]*([^#]*)', 1, 's') AS b
  FROM target WHERE contains(url, '://') AND contains(target, '://')
), side AS (SELECT a, b FROM link WHERE a <> b UNION SELECT b, a FROM link WHERE a <> b),
reach AS (
  SELECT a, b FROM side UNION SELECT r.a, s.b FROM reach r JOIN side s ON r.b = s.a
), split AS (
  SELECT a, b, regexp_extract(b, '^[^/?#]*', 0) AS h, regexp_extract(b, '^[^/?#]*([^?#]*)', 1, 's') AS p FROM reach
), alias AS (
  SELECT a, bool_or(v = 'block') AND NOT coalesce(bool_or(v = 'allow'), FALSE) AS blocked
  FROM (SELECT a, {_rule("h", "p", 0)} AS v FROM split) GROUP BY a
), judged AS (
  SELECT page_id, host, path, {_rule("host", "path", 1)} AS rule, {_rule("host", "path", 0)} AS own, node
  FROM (SELECT page_id, {_host("url")} AS host, {_path("url")} AS path,
    CASE WHEN contains(url, '://') THEN {_host("url")} || regexp_extract(url, '^.*?://[^/?#]*([^#]*)', 1, 's') END AS node
    FROM pages)
)
SELECT page_id, host, path, rule,
  coalesce(own, CASE WHEN alias.blocked THEN 'block' END, 'allow') AS verdict
FROM judged LEFT JOIN alias ON node = a
"""

def _spans_sql(rank: int, kind: str, pattern: str, group: int = 0, keep: str = "TRUE") -> str:
    """Spans of one kind: what lies between matches, and the matches, one after the other."""
    p = _literal(pattern)
    return f"""
  SELECT r, {rank} AS rank, '{kind}' AS kind, (sum(gap + n) OVER (PARTITION BY r ORDER BY i) - n)::BIGINT AS s,
    (sum(gap + n) OVER (PARTITION BY r ORDER BY i))::BIGINT AS e, {keep} AS good
  FROM (SELECT r, i, length(gaps[i]) AS gap, length(ms[i]) AS n, gs[i] AS g
    FROM (SELECT r, gaps, ms, gs, unnest(generate_series(1, len(ms))) AS i
      FROM (SELECT r, string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}, 0) AS ms,
        regexp_extract_all(text, {p}, {group}) AS gs FROM doc WHERE regexp_matches(text, {p}))))"""


_BASE_SQL = " UNION ALL ".join(
    _spans_sql(i, k, p, g, f"length(g) >= {least}") for i, (k, p, g, least) in enumerate(secret_scan.BASE_KINDS)
)
_STRONG = "regexp_matches(g, '[0-9]') AND regexp_matches(g, '[a-z]') AND regexp_matches(g, '[A-Z]')"
_WEAK_SQL = " UNION ALL ".join(
    _spans_sql(len(secret_scan.BASE_KINDS) + i, k, p, 0, _STRONG if role == "secret" else "TRUE")
    for i, (k, role, p) in enumerate(secret_scan.WEAK_KINDS)
)
_ROLE_SQL = " ".join(f"WHEN {rank} THEN '{role}'" for rank, role in enumerate(secret_scan.ROLES))
_NEAR_SQL = (
    "EXISTS (SELECT 1 FROM outer_part b WHERE a.r = b.r AND b.role = '{}' AND abs(a.s - b.s) <= "
    f"{secret_scan.REACH})"
)
_NEEDS_SQL = " OR ".join(
    " AND ".join([f"a.role = '{role}'", *[_NEAR_SQL.format(r) for r in sorted(needed)]])
    for role, choices in secret_scan.NEEDS.items() for needed in choices
)
_SECRET_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS (SELECT * FROM ({_BASE_SQL}) WHERE good),
part AS (SELECT * FROM base UNION ALL SELECT * FROM ({_WEAK_SQL}) WHERE good),
outer_part AS (
  SELECT *, CASE rank {_ROLE_SQL} END AS role
  FROM (SELECT *, max(e) OVER (PARTITION BY r ORDER BY s, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM part)
  WHERE rank < {len(secret_scan.BASE_KINDS)} OR before IS NULL OR s >= before
), extra AS (
  SELECT r, rank, kind, s, e FROM outer_part a WHERE rank >= {len(secret_scan.BASE_KINDS)} AND ({_NEEDS_SQL})
), of_base AS (
  SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS t, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
    count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex FROM base GROUP BY r
), of_all AS (
  SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS t, count(*) FILTER (WHERE rank >= {len(secret_scan.BASE_KINDS)}) AS n_linked
  FROM (SELECT r, rank, kind, s, e FROM base UNION ALL SELECT * FROM extra) GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(b.t, '')) AS base_sha256, coalesce(a.t, '') AS spans,
  coalesce(n_linked, 0)::BIGINT AS n_linked
FROM doc LEFT JOIN of_base b USING (r) LEFT JOIN of_all a USING (r)
"""

_QUALITY_SQL = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('host ' || source, 'null') AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), line AS (
  SELECT r, host, text, place, trim(regexp_replace(lower(l), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS line
  FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM doc)
), held_line AS (
  SELECT host, text, line, sum(words) AS words
  FROM (SELECT DISTINCT host, text, line, place, len(string_split(line, ' ')) AS words FROM line WHERE line <> '') GROUP BY host, text, line
), shared AS (
  SELECT * FROM held_line SEMI JOIN (SELECT host, line FROM held_line GROUP BY host, line HAVING count(*) > 1) USING (host, line)
), kind AS (
  SELECT host, text, CASE WHEN 100 * ("all" - coalesce(shared, 0)) < {quality.LEAST_LEFT_PERCENT} * "all"
    THEN 'like ' || least ELSE 'text ' || text END AS kind
  FROM (SELECT host, text, sum(words) AS "all" FROM held_line GROUP BY host, text)
    LEFT JOIN (SELECT host, text, sum(words) AS shared, min(('0x' || substr(md5(line), 1, 15))::BIGINT) AS least FROM shared GROUP BY host, text)
    USING (host, text)
), host_size AS (
  SELECT host, count(DISTINCT kind) AS documents FROM kind GROUP BY host
), frequent AS (
  SELECT host, line FROM shared JOIN kind USING (host, text) JOIN host_size USING (host) GROUP BY host, line
  HAVING 100 * count(DISTINCT kind) > greatest(100 * {quality.LINE_FLOOR}, {quality.LINE_PERCENT} * any_value(documents))
), gone AS (
  SELECT r, sum(len(string_split(line, ' '))) AS words FROM line SEMI JOIN frequent USING (host, line) GROUP BY r
), win AS (
  SELECT r, i, list_slice(w, i, i + 4) AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM doc WHERE len(w) >= 5)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1
), cover AS (
  SELECT r, sum(least(5, coalesce(following - i, 5))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM again) GROUP BY r
), filled AS (
  SELECT doc.r, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls FROM doc
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
    coalesce(gone.words, 0)::BIGINT AS n_boilerplate_words
  FROM doc JOIN filled USING (r) LEFT JOIN cover USING (r) LEFT JOIN gone USING (r)
)
SELECT *, NOT base_failed AND 100 * (n_words - n_boilerplate_words) >= {quality.LEAST_LEFT_PERCENT} * n_words AS kept
FROM (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted)
"""

def _price(count: str, total: str) -> str:
    return f"(1 + (1000000000::HUGEINT * ({count} + {divergence.PRIOR})) // ({total} + {divergence.PRIOR} * v))"


_TERM_SQL = "regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
_DIVERGENCE_SQL = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), occurs AS (
  SELECT r, lang, source, unnest({_TERM_SQL}) AS term FROM doc
), kept AS (
  SELECT lang, term FROM occurs GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.LEAST_DOCS}
), found AS (
  SELECT lang, source, term, count(*)::HUGEINT AS c FROM occurs SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), size AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
side AS (
  SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(c), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN size USING (lang) LEFT JOIN found USING (lang, source) GROUP BY lang, source
), priced AS (
  SELECT lang, source, term, coalesce(c, 0) AS c, {_price("coalesce(c, 0)", "n")} AS p
  FROM kept JOIN side USING (lang) LEFT JOIN found USING (lang, source, term)
), whole AS (
  SELECT lang, term, {_price("c", "n")} AS q
  FROM (SELECT lang, term, sum(c)::HUGEINT AS c FROM found GROUP BY lang, term) JOIN (SELECT lang, any_value(v) AS v, sum(n)::HUGEINT AS n FROM side GROUP BY lang) USING (lang)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM side a JOIN side b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON a.lang = apart.lang AND a.source = apart.source AND b.source = item
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM priced JOIN whole USING (lang, term) WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM part QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}
"""


def _leaf_sql(text: str) -> str:
    fields = [f"CAST({text if name == 'text' else name} AS VARCHAR)" for name in merkle.FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


# The lowest bit of a CRC-32, bit by bit, as DuckDB has no such function.
_EVEN_SQL = """list_reduce(list_prepend(4294967295, [ascii(x)::BIGINT FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))) & 1 = 1"""


def _climb_sql(start: str, nodes: str, name: str) -> str:
    """Replace a node and take its place up to the head; ``seen`` gathers the siblings on the way."""
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT w.r, w.tree, w.level + 1, w.i // 3, sha256(string_agg(CASE WHEN o.i = w.i THEN w.x ELSE o.h END, '' ORDER BY o.i)),
    w.seen || coalesce(string_agg(o.h, '' ORDER BY o.i) FILTER (WHERE o.i <> w.i), '')
  FROM {name} w JOIN {nodes} o ON o.tree = w.tree AND o.level = w.level AND o.i // 3 = w.i // 3
  WHERE o.n > 1 GROUP BY w.r, w.tree, w.level, w.i, w.x, w.seen)"""


def _tree_sql(start: str, name: str) -> str:
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM {name} WHERE n > 1 GROUP BY tree, level, i // 3)"""


_MERKLE_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_leaf_sql("text")} AS leaf,
    CASE WHEN {_EVEN_SQL} THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS changed
  FROM documents
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM hashed
), {_tree_sql("SELECT tree, 0 AS level, i, n, leaf AS h FROM placed", "node")},
head AS (SELECT tree AS i, h FROM node WHERE n = 1),
{_tree_sql("SELECT 0 AS tree, 0 AS level, i, count(*) OVER () AS n, h FROM head", "upper")},
{_climb_sql("SELECT r, tree, 0 AS level, i, changed AS x, '' AS seen FROM placed", "node", "low")},
{_climb_sql("SELECT r, 0 AS tree, 0 AS level, tree AS i, x, seen FROM low JOIN (SELECT tree, level FROM node WHERE n = 1) USING (tree, level)", "upper", "high")}
SELECT doc_id, leaf, head.h AS subroot, root.h AS root, sha256(seen) AS proof_sha256, x AS folded_root, x = root.h AS verified
FROM placed JOIN head ON head.i = placed.tree JOIN high USING (r)
  JOIN (SELECT level, h FROM upper WHERE n = 1) root USING (level)
"""

ORACLES: dict[str, str] = {
    "op2_secret_scan": _SECRET_SQL,
    "op9_quality_rules": _QUALITY_SQL,
    "op10_url_filter": _URL_SQL,
    "op11_source_divergence": _DIVERGENCE_SQL,
    "op13_merkle_manifest": _MERKLE_SQL,
}
