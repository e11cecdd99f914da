"""Line-first quality rules, as built-in expressions only.

Each line with a word is held against rules of four kinds:

* navigation: three or more parts between ``|``, or one of the characters » and ›;
* boilerplate, in lines of fewer than LONG words: whole words of NOTICES anywhere, or of ACTIONS at the line's beginning;
* punctuation of lines of LONG words or more: no sentence mark, unless the next line goes on with a small letter (wrapped
  prose);
* symbols: a share above MAX_SYMBOLS, or three or more doubled exclamation marks.

Failing lines go. A document is kept if it passes the base rules (at least MIN_WORDS words; at most MAX_REPEATED % of
them in repeated 8-word windows) and loses at most MAX_LOST % of its word characters with the failing lines.

Null and empty texts have no words: counts are 0, base_failed is true, kept is false, the cleaned text is ''. Rows
are judged one by one, so repeated rows and ties each get their own equal verdict. kept_documents() hands all other
columns on as they are, whatever they are called; judged() replaces those of its own names. All work is linear in the
text, long lines and words included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED, MAX_LOST, WINDOW = 20, 30, 50, 8
MAX_SYMBOLS = 10
LONG = 10
#: Fixed notices of sites, lower-case, in English, German, French and Spanish; a blank stands for what isn't a letter or digit.
NOTICES = [
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "enable javascript", "javascript is disabled", "lorem ipsum",
    "alle rechte vorbehalten", "cookie richtlinie", "datenschutzerklärung", "nutzungsbedingungen", "javascript aktivieren",
    "tous droits réservés", "politique de confidentialité", "conditions d utilisation", "mentions légales",
    "todos los derechos reservados", "política de privacidad", "política de cookies", "términos de uso", "aviso legal",
]
#: Fixed beginnings of lines that ask for a click.
ACTIONS = [
    "click here", "sign in", "log in", "share this", "subscribe to our newsletter",
    "hier klicken", "jetzt anmelden", "newsletter abonnieren",
    "cliquez ici", "se connecter", "abonnez vous",
    "haga clic aquí", "iniciar sesión", "suscríbase",
]
MARKS = ".!?:;…。！？؟।"
_WORD, _SPACE, _OTHER = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]", r"[^\p{L}\p{N}]"
LONG_RX = rf"^{_SPACE}*+(?:{_WORD}++{_SPACE}++){{{LONG - 1}}}{_WORD}"  # possessive: one pass, however long the words are


def _any_of(phrases: list[str]) -> str:
    return "(?:" + "|".join(p.replace(" ", f"{_OTHER}+") for p in phrases) + f")(?:{_OTHER}|$)"


NOTICES_RX, ACTIONS_RX = rf"(?:^|{_OTHER}){_any_of(NOTICES)}", rf"^{_OTHER}*+{_any_of(ACTIONS)}"


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ in order."""
    return F.array_remove(F.split(_text(text), r"[\x20\x09-\x0D]+"), "")


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def line_fails(line: Column, following: Column) -> Column:
    """Whether a line fails, given the next one (null: none)."""
    solid, low = without(line, SPACES), F.lower(line)
    n = F.length(solid)
    unfinished = ~line.rlike(f"[{MARKS}]") & ~F.coalesce(following.rlike(rf"^{_SPACE}*\p{{Ll}}"), F.lit(False))
    marked = (
        (F.length(line) - F.length(without(line, "|")) >= 2)
        | line.rlike("[»›]")
        | ((n - F.length(without(solid, SYMBOLS))) * 100 > n * MAX_SYMBOLS)
        | ((F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) >= 6)
    )
    # most lines hold none of the characters that these count
    return F.when(line.rlike(f"[{SYMBOLS}»›]|!!"), marked).otherwise(False) | F.when(line.rlike(LONG_RX), unfinished).otherwise(low.rlike(NOTICES_RX) | low.rlike(ACTIONS_RX))


def _repeated(hashes: Column) -> Column:
    """Words in windows whose hash is there twice or more: sorted by hash, equal neighbours give the windows' places, and each place covers up to the next one."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = F.transform(
        F.array(pairs),
        lambda p: F.sort_array(
            F.array_distinct(
                F.flatten(F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))
            )
        ),
    )
    covered = F.transform(
        places,
        lambda q: F.when(F.size(q) == 0, 0).otherwise(
            F.aggregate(F.zip_with(F.slice(q, 2, F.greatest(F.size(q) - 1, F.lit(0))), F.slice(q, 1, F.greatest(F.size(q) - 1, F.lit(0))), lambda b, a: F.least(b - a, F.lit(WINDOW))), F.lit(0), lambda s, x: s + x) + WINDOW
        ),
    )
    return covered[0]


def _windows(hashes: Column) -> Column:
    """A hash of each WINDOW hashes of words in a row; every word is hashed once."""
    return F.transform(F.array(hashes), lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))[0]


def _once(value: Column) -> Column:
    """value, as a column that no filter above is rewritten through: else it would be worked out again for every word of a text."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with clean_text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_bad_lines, lost_chars, base_failed and kept."""
    made = ["_words", "_lines", "_good", "_hashes"]
    t = _text(F.col(text))
    one = docs.withColumns({"_words": _once(words_of(F.col(text))), "_lines": _once(F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), "n_symbols": F.when(t.rlike(f"[{SYMBOLS}]"), F.length(t) - F.length(without(t, SYMBOLS))).otherwise(0).cast("long")})
    two = one.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_good": _once(F.filter("_lines", lambda x, i: ~line_fails(x, F.get("_lines", i + 1)))),
            "_hashes": _once(F.when(F.size("_words") >= WINDOW, _windows(F.transform("_words", lambda w: F.xxhash64(w))))),
        }
    )
    three = two.withColumns(
        {
            "n_bad_lines": (F.size("_lines") - F.size("_good")).cast("long"),
            "clean_text": F.array_join("_good", "\n"),
            "n_repeat_words": F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), _repeated(F.col("_hashes"))).otherwise(0).cast("long"),
        }
    )
    four = three.withColumns({"lost_chars": F.when(F.col("n_bad_lines") > 0, F.col("word_chars") - F.length(without(F.col("clean_text"), SPACES))).otherwise(0).cast("long"), "base_failed": (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)})
    return four.withColumn("kept", _once(~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("word_chars") * MAX_LOST))).drop(*made)


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, without their failing lines; columns as in docs (n_chars, where there is one, is the length of what is left)."""
    out = judged(docs.select(F.struct("*").alias("_row"), F.col(text).alias("text"))).filter("kept")
    left = {text: F.col("clean_text")}
    if "n_chars" in docs.columns:
        left["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[left.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    return judged(docs.select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_bad_lines", "lost_chars")


def _listed(phrases: list[str]) -> str:
    return ", ".join(f"' {p} '" for p in phrases)


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
o AS (
  SELECT doc_id, unnest(lines) AS l, unnest(range(1, len(lines) + 1)) AS i, unnest(list_append(lines[2:], NULL)) AS following
  FROM d),
q AS (
  SELECT doc_id, i, l, following, ' ' || trim(regexp_replace(lower(l), '[^\pL\pN]+', ' ', 'g')) || ' ' AS plain, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
    length(regexp_replace(l, '[^#*$%&|<>]', '', 'g')) AS symbols, length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g')) AS chars FROM o),
k AS (
  SELECT doc_id, list(l ORDER BY i) AS good FROM q
  WHERE NOT (len(string_split(l, '|')) >= 3 OR contains(l, '»') OR contains(l, '›') OR symbols * 100 > chars * {MAX_SYMBOLS} OR length(l) - length(replace(l, '!!', '')) >= 6
    OR (n >= {LONG} AND NOT regexp_matches(l, '[{MARKS}]') AND NOT coalesce(regexp_matches(following, '^[\x20\x09-\x0D]*\p{{Ll}}'), false))
    OR (n < {LONG} AND (len(list_filter([{_listed(NOTICES)}], lambda p: contains(plain, p))) > 0 OR len(list_filter([{_listed(ACTIONS)}], lambda p: starts_with(plain, p))) > 0)))
  GROUP BY doc_id),
g AS (SELECT d.*, coalesce(good, []) AS good FROM d LEFT JOIN k USING (doc_id)),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i+{WINDOW - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i FROM d)),
rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1),
cov AS (
  SELECT doc_id, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
m AS (
  SELECT g.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         (len(lines) - len(good))::BIGINT AS n_bad_lines,
         (length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) - length(regexp_replace(array_to_string(good, chr(10)), '[\x20\x09-\x0D]', '', 'g')))::BIGINT AS lost_chars
  FROM g LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost_chars * 100 <= word_chars * {MAX_LOST} AS kept, n_bad_lines, lost_chars FROM b
"""
