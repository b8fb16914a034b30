"""Quality rules as a bitmask ledger, by built-in functions only.

``ledger`` measures every text once and evaluates every rule once: a row holds the measurements and one bit per
failed rule. Policies are versioned sets of rules; applying one, or asking what a rule's removal would change, reads
only the ledger's bits, never the texts.

Defined results: a null or empty text has no words, all counts are 0 and the base rules reject it. A null or repeated
doc_id is a row like any other. Columns of the input with the names of ledger columns are replaced by them; other
columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import let, words

SYMBOLS = "#*$%&|<>"
#: A stretch of at least 16 characters that begins with a capital and has no small Latin letter.
CAPS = "[A-Z][^a-z]{15,}"

#: name -> failure condition over the measurements. A rule's bit is its place in this list: append only.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 50",
    "repeated_phrases": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "shouting": "2 * n_caps > n_chars_all",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    # since v3: half of a text that is mostly cased letters is in capitals; long words, but for scripts written without spaces
    "capitals": "2 * n_upper > n_cased AND 2 * n_cased > word_chars",
    "long_spaced_words": "2 * n_unspaced <= word_chars AND word_chars - n_unspaced > 20 * n_words",
}
#: Policies are frozen once used; a change is a new version.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_phrases"),
    "v1": ("too_few_words", "repeated_phrases", "symbols", "shouting"),
    "v2": ("too_few_words", "repeated_phrases", "symbols", "shouting", "repeated_lines", "short_words", "long_words"),
    "v3": ("too_few_words", "repeated_phrases", "symbols", "capitals", "repeated_lines", "short_words", "long_spaced_words"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_caps", "n_chars_all", "n_lines")
#: Measurements that rules since v3 need besides: the characters of these classes.
LATER_MEASURES = {
    "n_upper": r"\p{Lu}",
    "n_cased": r"[\p{Lu}\p{Ll}]",
    "n_unspaced": r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}\p{IsYi}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]",
}


def mask(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


#: Up to so many repeated window hashes are looked up one by one; above, windows are sorted with their places. Both give the same count.
FEW = 16


def _repeat_words(w: Column) -> Column:
    """Words in 3-word windows that occur twice or more.

    Windows of one text are told apart by their 64-bit hash. A text whose sorted hashes hold no equal neighbours is done; else
    the places of the repeated ones are found, and each adds the words that the place before it hasn't covered. n log n steps.
    """
    rest = lambda a: F.slice(a, 2, 2**30)
    truth = lambda c: F.coalesce(c, F.lit(False))
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    repeated = lambda s: F.array_distinct(F.filter(s, lambda x, i: truth(x == F.get(s, i + 1))))

    def few(h: Column, d: Column) -> Column:
        return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(d, x), i)), lambda p: p.isNotNull())

    def many(h: Column) -> Column:
        at = lambda s, e: F.filter(s, lambda x, i: truth(F.get(e, i)) | truth(F.get(e, i - 1)))
        equal_next = lambda s: F.zip_with(s, rest(s), lambda x, y: x["h"] == y["h"])
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return let(ordered, lambda s: let(equal_next(s), lambda e: F.sort_array(F.transform(at(s, e), lambda x: x["p"]))))

    def covered(r: Column) -> Column:
        steps = F.zip_with(r, rest(r), lambda a, b: F.when(b.isNull(), 0).otherwise(F.least(F.lit(3), b - a)))
        return F.lit(3) + F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    places = lambda h, d: F.when(F.size(d) <= FEW, few(h, d)).otherwise(many(h))
    count = lambda h: let(let(F.sort_array(h), repeated), lambda d: F.when(F.size(d) == 0, 0).otherwise(let(places(h, d), covered)))
    return F.when(F.size(w) < 3, 0).otherwise(let(hashes, count))


def ledger(docs: DataFrame, text: str = "text", policy: str = "v2") -> DataFrame:
    """docs with the measurements (MEASURES, long) and ``failures`` (long, a bit per rule). No shuffle: texts are read once, in place.

    The rules are those of RULES up to the policy's last, so that a ledger of v2 stays as it was; that of v3 has LATER_MEASURES too.
    """
    rules = list(RULES.items())[: mask(policy).bit_length()]
    later = {name: chars for name, chars in LATER_MEASURES.items() if any(name in rule for _, rule in rules)}
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^ \x09-\x0D]"))
    of_words = lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), _repeat_words(w).alias("n_repeat_words"))
    of_lines = lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))
    kept = docs.drop(*MEASURES, *later, "failures") if text not in (*MEASURES, *later) else docs
    measured = kept.select(
        "*",
        let(words(F.col(text)), of_words).alias("__w"),
        let(lines, of_lines).alias("__l"),
        F.length(t).alias("__chars"),
        F.when(t.rlike(f"[{SYMBOLS}]"), F.length(t) - F.length(F.regexp_replace(t, f"[{SYMBOLS}]+", ""))).otherwise(0).alias("__symbols"),
        F.when(t.rlike(CAPS), F.length(t) - F.length(F.regexp_replace(t, CAPS, ""))).otherwise(0).alias("__caps"),
        *(F.when(t.rlike(chars), F.length(t) - F.length(F.regexp_replace(t, f"{chars}+", ""))).otherwise(0).alias(f"__{name}") for name, chars in later.items()),
    )
    named = {
        "n_words": F.col("__w.n_words"), "word_chars": F.col("__w.word_chars"), "n_symbols": F.col("__symbols"), "n_dup_lines": F.col("__l.n_dup_lines"),
        "n_repeat_words": F.col("__w.n_repeat_words"), "n_caps": F.col("__caps"), "n_chars_all": F.col("__chars"), "n_lines": F.col("__l.n_lines"),
        **{name: F.col(f"__{name}") for name in later},
    }
    measured = measured.withColumns({k: v.cast("long") for k, v in named.items()}).drop("__w", "__l", "__chars", "__symbols", "__caps", *(f"__{name}" for name in later))
    bits = sum((F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, rule) in enumerate(rules)), F.lit(0).cast("long"))
    return measured.withColumn("failures", bits)


def passes(policy: str, failures: str = "failures") -> Column:
    """True where no rule of the policy failed."""
    return F.col(failures).bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(ledger_rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: rows that fail it, fail it alone (its removal would keep them), and the rows kept with and without it.

    The ledger is first counted by its distinct bit sets (at most 2 to the number of rules), so only these counts are shuffled.
    """
    m = mask(policy)
    by_bits = ledger_rows.groupBy(F.col("failures").bitwiseAND(F.lit(m).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    names = list(RULES)
    rules = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(1 << names.index(rule)).cast("long").alias("bit")) for rule in POLICIES[policy]])
    each = by_bits.select("bits", "n", F.explode(rules).alias("r"))
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        total(F.col("bits").bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
        total(F.col("bits") == F.col("r.bit")).alias("n_failed_alone"),
        total(F.col("bits") == 0).alias("n_kept"),
        total(rest == 0).alias("n_kept_without"),
    )


def quality_report(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """One row per document: the measurements, the failure bits, base_failed and kept."""
    rows = ledger(docs.select("doc_id", "text"), policy=policy)
    base_ok = passes("base")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~base_ok).alias("base_failed"),
        (base_ok & passes(policy)).alias("kept"), "n_caps", "n_lines", "failures",
    )


def keep_good(docs: DataFrame, policy: str = "v3") -> DataFrame:
    """The documents that the policy and the base rules keep, with their own columns."""
    marked = ledger(docs.select(F.struct(*docs.columns).alias("__doc"), F.col("text").alias("__text")), text="__text", policy=policy)
    return marked.filter(passes("base") & passes(policy)).select("__doc.*")


#: DuckDB. Words and lines as lists; repeated windows by a per-document count.
REPORT_SQL = """
WITH t AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(string_split(translate(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: length(translate(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) > 0) AS lines
  FROM t),
g AS (
  SELECT rid, unnest(range(1, len(words) - 1)) AS p, words FROM w WHERE len(words) >= 3),
g3 AS (
  SELECT rid, p, count(*) OVER (PARTITION BY rid, words[p], words[p + 1], words[p + 2]) AS c FROM g),
cov AS (
  SELECT rid, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM g3 WHERE c > 1) GROUP BY rid),
m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    (length(text) - length(regexp_replace(text, '[A-Z][^a-z]{15,}', '', 'g')))::BIGINT AS n_caps, length(text) AS n_chars_all, len(lines)::BIGINT AS n_lines
  FROM w LEFT JOIN cov USING (rid)),
b AS (
  SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
    + 8 * (2 * n_caps > n_chars_all)::BIGINT + 16 * (2 * n_dup_lines > n_lines)::BIGINT
    + 32 * (word_chars < 2 * n_words)::BIGINT + 64 * (word_chars > 20 * n_words)::BIGINT)::BIGINT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 AS base_failed, failures = 0 AS kept,
  n_caps, n_lines, failures FROM b
"""
