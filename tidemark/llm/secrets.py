"""Secret candidates with their ownership across the corpus, as built-in expressions only.

Candidates are found in every text: the base kinds of the contract (assign, access, hex) and vendor tokens. The hash
of each candidate's value is counted over the corpus by distinct repositories and owners. A value that MANY_OWNERS or
more owners have, or two owners or more in MANY_REPOS or more repositories, is a copied example; the others look live.
Base spans are always reported; vendor spans are added where they look live.

Owner and repository are columns of the input (source and source/lang for documents); a null counts as an owner of
its own. Counts are taken first per (value, owner, repository), so that a value that a third of all rows hold meets
as one row from each task, and what is known of it goes back once for each part of the rows. Null and empty texts have
no candidates. Rows with equal doc_id are kept apart: each input row gives one row. Offsets are code points, end
exclusive. redacted() hands all other columns on as they are, whatever they are called; scanned() replaces those of its
own names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import written

MANY_OWNERS, MANY_REPOS = 3, 6
#: Rows with spans to a part, about.
PART = 1 << 16


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: Kind: pattern, group of the value, least length of the value.
BASE = {
    "assign": (rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"(AKIA[A-Z0-9]+)", 1, 20),
    "hex": (r"([0-9a-f]+)", 1, 24),
}
#: Fixed forms of vendors' tokens.
VENDOR = {"vendor": (r"(gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,})", 1, 10)}
KINDS = BASE | VENDOR
_SPAN = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,value:string>>"


#: What decides quickly that a text has no match of a kind that is reported.
_QUICK = {"hex": r"[0-9a-f]{24}", "access": r"AKIA[A-Z0-9]{16}", "assign": rf"""(?:{_NAMES})["']?\x20*[:=]"""}


def spans(text: Column, kind: str) -> Column:
    """Matches of a kind, leftmost and non-overlapping, with their places: a match starts where the pieces between matches and the matches before it end."""
    pattern, group, least = KINDS[kind]
    no = list(KINDS).index(kind)
    if kind == "hex":  # whole runs either way
        pattern = r"([0-9a-f]{24,})"
    found = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long")).alias("gap"),
        F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)).alias("all"),
        F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(group + 1)).alias("value"),
    )
    empty = F.array().cast(_SPAN)
    placed = F.aggregate(
        found,
        F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")),
        lambda s, m: F.struct(
            (s["at"] + m["gap"] + F.coalesce(F.length(m["all"]), F.lit(0))).cast("long").alias("at"),
            F.when(
                F.length(m["value"]) >= least,
                F.concat(s["out"], F.array(F.struct((s["at"] + m["gap"]).alias("start"), F.lit(no).alias("kind_no"), (s["at"] + m["gap"] + F.length(m["all"])).cast("long").alias("end"), F.lit(kind).alias("kind"), m["value"].alias("value"))).cast(_SPAN)),
            )
            .otherwise(s["out"])
            .alias("out"),
        ),
    )["out"]
    return F.when(text.rlike(_QUICK.get(kind, pattern)), placed).otherwise(empty)


def candidates(docs: DataFrame, text: str = "text", owner: Column | None = None, repo: Column | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For each row of docs: row (its number), kept (a struct of the columns keep), owner, repo, and the array spans of all kinds by place. Written once: the texts are read one time only."""
    t = F.coalesce(F.col(text), F.lit(""))
    owner = F.col("source") if owner is None else owner
    repo = F.concat_ws("/", "source", "lang") if repo is None else repo
    found = docs.select(F.struct(*keep).alias("kept"), owner.alias("owner"), repo.alias("repo"), F.concat(*[spans(t, k) for k in KINDS]).alias("spans"))
    return written(found.withColumn("row", F.monotonically_increasing_id()), "secrets")


def ownership(found: DataFrame, many_owners: int = MANY_OWNERS, many_repos: int = MANY_REPOS) -> DataFrame:
    """Each candidate value's hash with n_places, n_repos, n_owners and copied."""
    each = found.filter(F.size("spans") > 0).select("owner", "repo", F.explode("spans").alias("s")).groupBy(F.sha2(F.col("s")["value"], 256).alias("value_hash"), F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repo", F.lit("")).alias("repo")).agg(F.count("*").alias("n"))
    owned = each.groupBy("value_hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("r"))
    copied = (F.col("n_owners") >= many_owners) | ((F.col("n_owners") > 1) & (F.col("n_repos") >= many_repos))
    return owned.groupBy("value_hash").agg(F.sum("n").alias("n_places"), F.sum("r").alias("n_repos"), F.count("*").alias("n_owners")).withColumn("copied", copied)


_FULL = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,value:string,copied:boolean,n_repos:bigint,n_owners:bigint>>"


def _judged(found: DataFrame, many_owners: int, many_repos: int) -> DataFrame:
    """kept and spans, with what is known of each span's value, of every row of candidates()."""
    some = found.filter(F.size("spans") > 0)
    parts = max(1, some.count() // PART) * 32
    each = some.select("row", F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part"), F.explode("spans").alias("s")).withColumn("value_hash", F.sha2(F.col("s")["value"], 256))
    needed = each.select("value_hash", "part").distinct().join(ownership(found, many_owners, many_repos), "value_hash")
    known = each.join(needed, ["value_hash", "part"]).filter(~(F.col("s")["kind"].isin(*VENDOR) & F.col("copied")))
    span = F.struct(*[F.col("s")[c].alias(c) for c in ("start", "kind_no", "end", "kind", "value")], "copied", "n_repos", "n_owners")
    of_row = known.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("all"))
    return found.select("row", "kept").join(of_row, "row", "left").select("kept", F.coalesce("all", F.array().cast(_FULL)).alias("spans"))


def scanned(docs: DataFrame, many_owners: int = MANY_OWNERS, many_repos: int = MANY_REPOS, keep: tuple[str, ...] = ("doc_id",), **columns) -> DataFrame:
    """One row per row of docs: keep, spans (array of start, end, kind, value, copied, n_repos, n_owners), n_live, n_copied, and most_repos and most_owners (of a value's; 0: no spans)."""
    out = _judged(candidates(docs, keep=keep, **columns), many_owners, many_repos)
    counts = {"n_live": F.size(F.filter("spans", lambda s: ~s["copied"])).cast("long"), "n_copied": F.size(F.filter("spans", lambda s: s["copied"])).cast("long")}
    counts |= {f"most_{k}": F.coalesce(F.array_max(F.col("spans")[f"n_{k}"]), F.lit(0)).cast("long") for k in ("repos", "owners")}
    made = ["spans", *counts]
    return out.select(*[F.col("kept")[c].alias(c) for c in keep if c not in made], "spans", *[v.alias(k) for k, v in counts.items()])


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scanned(docs).select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"), "n_live", "n_copied", "most_repos", "most_owners")


def redacted(docs: DataFrame, many_owners: int = MANY_OWNERS, many_repos: int = MANY_REPOS, text: str = "text", **columns) -> DataFrame:
    """docs with every live-looking span in text replaced by its kind in brackets; copied examples stay. Columns as in docs (n_chars, where there is one, is the length of what is left)."""
    cols = docs.columns
    out = _judged(candidates(docs, text, keep=tuple(cols), **columns), many_owners, many_repos)
    t = F.col("kept")[text]
    live = F.filter("spans", lambda s: ~s["copied"])
    # overlapping spans: what is already written over is not repeated
    done = F.aggregate(
        live,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring(t, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("["), s["kind"], F.lit("]"))).otherwise(a["out"]).alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring(t, (a["at"] + 1).cast("int"), F.length(t))),
    )
    out = out.select("kept", F.when(F.size(live) > 0, done).otherwise(t).alias("left"))
    left = {text: F.col("left")}
    if "n_chars" in cols:
        left["n_chars"] = F.length("left").cast(docs.schema["n_chars"].dataType)
    return out.select(*[left.get(c, F.col("kept")[c]).alias(c) for c in cols])


def _sql_spans(kind: str) -> str:
    pattern, group, least = KINDS[kind]
    pattern = pattern.replace("'", "''")
    no = list(KINDS).index(kind)
    # the text with each match put between two marks gives the pieces' lengths
    return f"""
  SELECT doc_id, source, lang, {no} AS kind_no, '{kind}' AS kind, sum(len(x)) OVER w - len(x) AS start, sum(len(x)) OVER w AS "end", regexp_extract(x, '{pattern}', {group}) AS value, j
  FROM (SELECT doc_id, source, lang, unnest(p) AS x, generate_subscripts(p, 1) AS j FROM (SELECT doc_id, source, lang, string_split(regexp_replace(coalesce(text, ''), '({pattern})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS p FROM documents))
  WINDOW w AS (PARTITION BY doc_id ORDER BY j)"""


ORACLE = (
    "WITH m AS ("
    + " UNION ALL ".join(f"SELECT * FROM ({_sql_spans(k)}) WHERE j % 2 = 0 AND length(value) >= {KINDS[k][2]}" for k in KINDS)
    + f"""),
v AS (SELECT DISTINCT value, coalesce(source, '') AS owner, concat_ws('/', source, lang) AS repo FROM m),
n AS (SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repo)) AS repos FROM v GROUP BY value),
o AS (SELECT *, owners >= {MANY_OWNERS} OR (owners >= 2 AND repos >= {MANY_REPOS}) AS copied FROM n),
s AS (SELECT m.*, o.copied, o.owners, o.repos FROM m JOIN o USING (value) WHERE NOT (kind = 'vendor' AND copied)),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, kind_no) FILTER (kind <> 'vendor') AS base,
    string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, kind_no) AS spans, count(*) FILTER (NOT copied) AS n_live, count(*) FILTER (copied) AS n_copied, max(repos) AS most_repos, max(owners) AS most_owners
  FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_copied, 0)::BIGINT AS n_copied, coalesce(most_repos, 0)::BIGINT AS most_repos, coalesce(most_owners, 0)::BIGINT AS most_owners
FROM documents LEFT JOIN a USING (doc_id)"""
)
