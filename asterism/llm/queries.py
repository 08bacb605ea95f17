"""The registered queries of this subpackage and their DuckDB SQL.

Each reads its whole table and hands its operator only the columns it needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from asterism.llm import (
    collocations,
    decontaminate,
    html_main,
    jaccard_join,
    licenses,
    mixing,
    personal_data,
    quality_cnn,
    quality_rules,
    token_counts,
    token_files,
    warc,
    whitening,
)
from asterism.llm.common import read
from asterism.llm.license_texts import TEXTS
from asterism.sources.staging import scratch_root


def op1_mix(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.mix_sizes(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = quality_rules.quality_verdicts(read(spark, sf, "documents"), read(spark, sf, "labels"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op3_quality_cnn(spark: SparkSession, sf: str) -> DataFrame:
    return quality_cnn.classify(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.derivatives(warc.responses_from_pages(read(spark, sf, "pages")), "page_id")


def op7_html_main(spark: SparkSession, sf: str) -> DataFrame:
    return html_main.extract_main_text(read(spark, sf, "pages"))


def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf, "documents"))


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_root(spark)
    token_files.write_token_files(read(spark, sf, "documents"), root, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_token_files(spark, root)


def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf, "documents"))


def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(read(spark, sf, "embeddings"))


def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(read(spark, sf, "documents"))


def op13_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return personal_data.span_digests(personal_data.find_personal_data(read(spark, sf, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_quality_rules": op2_quality_rules,
    "op3_quality_cnn": op3_quality_cnn,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_counts": op5_token_counts,
    "op6_warc": op6_warc,
    "op7_html_main": op7_html_main,
    "op8_license_scan": op8_license_scan,
    "op9_token_files": op9_token_files,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_personal_data": op13_personal_data,
}

_SIZE = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"



def license_sql(texts: dict[str, list[str]] = TEXTS, docs: str = "documents") -> str:
    """The licence scan in SQL, digests of the known texts and all."""

    def replaced(text: str, pairs: tuple[tuple[str, str], ...]) -> str:
        for other, ours in pairs:
            text = f"replace({text}, '{other}', '{ours}')"
        return text

    def canonical(part: str) -> str:
        form = f"regexp_replace(trim({part}), '{licenses.ITEM}', '\\1', 'g')"
        form = f"trim(regexp_replace({form}, '{licenses.PUNCTUATION}', ' ', 'g'))"
        return replaced(form, licenses.PHRASES)

    def paragraphs(lines: str) -> str:
        parts = f"regexp_split_to_array(array_to_string({lines}, ' '), '{licenses.BREAK}')"
        return f"list_filter(list_transform({parts}, lambda p: {canonical('p')}), lambda p: p <> '')"

    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    lowered = replaced(lowered, licenses.SPELLINGS)
    owned = f"regexp_matches(x, '{licenses.COPYRIGHT_LINE}')"
    words = f"CASE WHEN regexp_matches(x, '{licenses.WORDS}') THEN x ELSE chr(10) END"
    quoted = {name: [text.replace("'", "''") for text in of] for name, of in texts.items()}
    values = ", ".join(f"('{name}', '{text}')" for name, of in quoted.items() for text in of)
    return f"""
WITH t(doc_id, name, text) AS (
  SELECT NULL, * FROM (VALUES {values}) UNION ALL SELECT doc_id, NULL, text FROM {docs}),
l AS (SELECT *, list_transform(string_split({lowered}, chr(10)), lambda x: regexp_replace(x, '{licenses.DECORATION}', '')) AS all_lines
      FROM (SELECT *, row_number() OVER () AS i FROM t)),
o AS (SELECT *, list_transform(all_lines, lambda x: CASE WHEN {owned} THEN chr(10) ELSE {words} END) AS kept FROM l),
f AS (SELECT i, doc_id, name, {paragraphs("kept")} AS ps,
             list_transform(list_filter(kept, lambda x: x <> chr(10)), lambda x: {canonical("x")}) AS singles,
             CASE WHEN len(list_filter(all_lines, lambda x: {owned})) > 0
                  THEN md5(coalesce(array_to_string({paragraphs(f"list_transform(all_lines, lambda x: {words})")}, ' '), '')) END AS as_is
      FROM o),
d AS (SELECT *, md5(coalesce(array_to_string(ps, ' '), '')) AS digest FROM f),
k AS (SELECT known, min(name) AS name
      FROM (SELECT name, unnest([digest, as_is]) AS known FROM d WHERE name IS NOT NULL)
      WHERE known <> md5('') GROUP BY known),
n AS (SELECT i, string_agg(DISTINCT k.name, ',' ORDER BY k.name) AS notices
      FROM (SELECT i, md5(unnest(list_concat(singles, ps))) AS known FROM d WHERE name IS NULL) JOIN k USING (known) GROUP BY i)
SELECT d.doc_id, d.digest, coalesce(a.name, b.name) AS license, coalesce(n.notices, '') AS notices
FROM d LEFT JOIN k a ON d.digest = a.known LEFT JOIN k b ON d.as_is = b.known LEFT JOIN n USING (i)
WHERE d.name IS NULL"""


_COLLOCATIONS = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
o AS (SELECT lang, 1 AS words, unnest(w) AS phrase FROM w
      UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
      UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
t AS (SELECT lang, count(*) AS n FROM o WHERE words = 1 GROUP BY lang),
f AS (SELECT lang, words, phrase, count(*) AS f FROM o GROUP BY lang, words, phrase HAVING count(*) >= 10),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS x FROM f WHERE words >= 2),
k AS (SELECT lang, words, phrase, a, 1 AS cut, x[1] AS part, array_to_string(x[2:], ' ') AS rest FROM c
      UNION ALL SELECT lang, words, phrase, a, 2, x[1] || ' ' || x[2], x[3] FROM c WHERE words = 3),
s AS (SELECT k.*, l.f AS l, r.f AS r,
             CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = k.part JOIN f r ON r.lang = k.lang AND r.phrase = k.rest),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
u AS (SELECT lang, phrase, max(a) AS most
      FROM (SELECT lang, a, x[1] || ' ' || x[2] AS phrase FROM c WHERE words = 3
            UNION ALL SELECT lang, a, x[2] || ' ' || x[3] FROM c WHERE words = 3) GROUP BY lang, phrase)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
       b.phrase, a, l, r, n, score
FROM b JOIN t ON t.lang = b.lang LEFT JOIN u ON u.lang = b.lang AND u.phrase = b.phrase
WHERE most IS NULL OR 100 * most < 50 * a
QUALIFY rank <= 2000"""


ORACLES: dict[str, str] = {
    "op12_collocations": _COLLOCATIONS,
    "op8_license_scan": license_sql(),
    "op1_mix": f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce({_SIZE}, 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
      FROM d GROUP BY source),
o AS (SELECT *, source_size * 3 AS stop, row_number() OVER (ORDER BY source_size * 3 / w, source NULLS LAST) AS k FROM s),
l AS (SELECT *, (SELECT sum(source_size) FROM s) - coalesce(sum(stop) OVER b, 0) AS words_left,
             (SELECT sum(w) FROM s) - coalesce(sum(w) OVER b, 0) AS w_left
      FROM o WINDOW b AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, CAST(words_left AS DOUBLE) / CAST(w_left AS DOUBLE) AS level,
             CAST(words_left AS DOUBLE) / CAST(w_left AS DOUBLE) >= CAST(stop AS DOUBLE) / w AS stopped FROM l),
t AS (SELECT source, source_size,
             CASE WHEN stopped THEN CAST(stop AS DOUBLE) ELSE (SELECT arg_min(level, k) FROM f WHERE NOT stopped) * w END AS target
      FROM f),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM t),
p AS (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS place FROM d),
c AS (SELECT p.doc_id, p.size, r.source_size, r.target,
             CAST(least(floor({{offset}}::DOUBLE + rate * place) - floor({{offset}}::DOUBLE + rate * (place - 1)), 3) AS BIGINT) AS copies
      FROM p JOIN r ON p.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c""".replace(
        "{offset}", repr(mixing.offset())
    ),
}
