"""Secret scans, with SQL functions only.

Patterns of three base kinds are reported wherever they match. Weak kinds match things that
are harmless alone: logins, addresses of services, short passwords, unmarked keys. They are
reported only where parts that complete each other stand within one scope: a secret with the
identifier it belongs to, or with the endpoint it opens. The parts are joined by intervals:
each is dealt to the stretches of text that its scope touches, and stretches are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

SCOPE = 200      # characters between parts that may belong together
STRETCH = 512    # characters of a stretch of text in the interval join

# A character of private use stands around matches while they are located.
EDGE, INSTEAD = "\ue000", "\ue001"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _one_of(*words: str) -> str:
    return "(" + "|".join(map(_either_case, words)) + ")"


_ASSIGNED = r"""["']?\x20*[:=]\x20*["']?"""

# kind: pattern, least length of the match, most length, role of the part. Fixed values for
# the base kinds, which come first; the order is that of equal starts.
BASE_KINDS = {
    "assign": (
        _one_of("password", "passwd", "secret", "token", "api_?key") + _ASSIGNED + r"([A-Za-z0-9+/_.=-]+)",
        0, None, "secret",
    ),
    "access": (r"AKIA[A-Z0-9]+", 20, None, "identifier"),
    "hex": (r"[0-9a-f]+", 24, None, "secret"),
}
LEAST_ASSIGNED = 6   # characters of the value of ``assign``
# What may precede a fixed character is of bounded length: long runs would be read again
# from each of their characters.
WEAK_KINDS = {
    "short": (_one_of("pwd", "pass", "pin", "passphrase") + _ASSIGNED + r"[!-~]{4,}", 0, None, "secret"),
    "key40": (r"[A-Za-z0-9/+=]{40,}", 40, 40, "secret"),
    "login": (_one_of("user", "username", "login", "client_?id", "account") + _ASSIGNED + r"[A-Za-z0-9._@-]{3,}",
              0, None, "identifier"),
    "mail": (r"[A-Za-z0-9._+-]{1,64}@[A-Za-z0-9-]{1,63}[.][A-Za-z0-9.-]+", 0, None, "identifier"),
    "address": (r"[a-z][a-z0-9+]{1,14}://[!-~]+", 0, None, "endpoint"),
    "host": (_one_of("host", "hostname", "server", "endpoint") + _ASSIGNED + r"[A-Za-z0-9._:-]{3,}",
             0, None, "endpoint"),
}
KINDS = {**BASE_KINDS, **WEAK_KINDS}
# Without one of these nothing in a text can be reported.
SUSPECT = {
    **{k: v[0] for k, v in BASE_KINDS.items()},
    "hex": r"[0-9a-f]{24}",
    "short": WEAK_KINDS["short"][0],
    "key40": WEAK_KINDS["key40"][0],
}


def text_key(text: str = "text") -> Column:
    """What stands for a text: equal texts have equal spans."""
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def locate_parts(texts: DataFrame) -> DataFrame:
    """Parts of every kind in ``texts(key, text)``, of distinct keys:
    ``key, kind, kind_no, role, start, stop`` in characters, ``stop`` exclusive.

    Matches of a kind are the leftmost that do not overlap; those of a wrong length are
    dropped after that.
    """
    plain = F.replace(F.col("text"), F.lit(EDGE), F.lit(INSTEAD))
    cut = [
        F.struct(
            F.lit(kind).alias("kind"), F.lit(k).alias("kind_no"), F.lit(role).alias("role"),
            F.lit(least).alias("least"), F.lit(most).cast("int").alias("most"),
            F.split(F.regexp_replace(plain, pattern, f"{EDGE}$0{EDGE}"), EDGE).alias("pieces"),
        )
        for k, (kind, (pattern, least, most, role)) in enumerate(KINDS.items())
    ]
    pieces = (
        texts.select("key", F.explode(F.array(*cut)).alias("c"))
        .where(F.size("c.pieces") > 1)
        .select("key", "c.kind", "c.kind_no", "c.role", "c.least", "c.most",
                F.posexplode("c.pieces").alias("i", "piece"))
    )
    # Pieces of one text and kind; every second one is a match.
    before = Window.partitionBy("key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("piece")
    placed = pieces.select(
        "*", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("int").alias("start"), length.alias("length")
    )
    value = F.regexp_extract("piece", BASE_KINDS["assign"][0], 2)
    return placed.where(
        (F.col("i") % 2 == 1)
        & (F.col("length") >= F.col("least"))
        & (F.col("most").isNull() | (F.col("length") <= F.col("most")))
        & ((F.col("kind") != "assign") | (F.length(value) >= LEAST_ASSIGNED))
    ).select("key", "kind", "kind_no", "role", "start", (F.col("start") + F.col("length")).alias("stop"))


def _dealt(parts: DataFrame, margin: int) -> DataFrame:
    """Parts, once for each stretch that they touch with their margin."""
    def stretch(at: Column) -> Column:
        return F.floor(at / STRETCH).cast("int")

    reach = F.sequence(stretch(F.col("start") - margin), stretch(F.col("stop") + margin))
    return parts.withColumn("stretch", F.explode(reach))


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts that a complementary part completes, and that lie in no base part."""
    base = F.col("kind").isin(*BASE_KINDS)
    weak, near = _dealt(parts.where(~base), scope).alias("w"), _dealt(parts, 0).alias("p")
    same = (F.col("w.key") == F.col("p.key")) & (F.col("w.stretch") == F.col("p.stretch"))
    within = (F.col("p.start") <= F.col("w.stop") + scope) & (F.col("p.stop") >= F.col("w.start") - scope)
    completes = (F.col("w.role") == "secret") != (F.col("p.role") == "secret")
    linked = weak.join(near, same & within & completes, "left_semi").select(*parts.columns).distinct()

    own, covering = _dealt(linked, 0).alias("w"), _dealt(parts.where(base), 0).alias("p")
    overlap = (F.col("p.start") < F.col("w.stop")) & (F.col("p.stop") > F.col("w.start"))
    covered = own.join(covering, same & overlap, "left_semi").select(*parts.columns).distinct()
    return linked.join(covered, parts.columns, "left_anti")


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id`` and ``found``, an array of spans
    ``start, kind_no, kind, stop``, by start and then kind.

    Null and empty texts have none. Copies of a text are scanned once. Repeated rows give
    repeated results, no rows none. Other columns are not read.
    """
    suspect = None
    for pattern in SUSPECT.values():
        hit = F.col("text").rlike(pattern)
        suspect = hit if suspect is None else suspect | hit
    texts = (
        docs.where(suspect).select(text_key().alias("key"), "text")
        .groupBy("key").agg(F.first("text").alias("text"))
    )
    parts = stage(locate_parts(texts), "secret-parts")
    weak = link_parts(parts, scope)
    spans = parts.where(F.col("kind").isin(*BASE_KINDS)).unionByName(weak)
    found = spans.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind_no", "kind", "stop"))).alias("found")
    )
    found = stage(found, "secret-spans")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("key")).join(
        found, "key", "left"
    ).select(
        "doc_id",
        F.coalesce("found", F.array().cast("array<struct<start:int,kind_no:int,kind:string,stop:int>>")).alias("found"),
    )


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text."""
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind_no"] < len(BASE_KINDS))
    return find_secrets(docs).select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def oracle() -> str:
    """The same in DuckDB's SQL, by its own joins: no stretches, each pair of parts compared."""
    def text_of(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    cut = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS kind_no, {text_of(kind)} AS kind, {text_of(role)} AS role, {least} AS least, "
        f"{most or 'NULL'} AS most, string_split(regexp_replace(text, {text_of(pattern)}, "
        f"chr({ord(EDGE)}) || '\\0' || chr({ord(EDGE)}), 'g'), chr({ord(EDGE)})) AS pieces FROM texts"
        for k, (kind, (pattern, least, most, role)) in enumerate(KINDS.items())
    )
    n = len(BASE_KINDS)
    return f"""
WITH texts AS (
    SELECT doc_id, replace(coalesce(text, ''), chr({ord(EDGE)}), chr({ord(INSTEAD)})) AS text FROM documents
), cut AS ({cut}
), pieces AS (
    SELECT doc_id, kind_no, kind, role, least, most,
        unnest(pieces) AS piece, generate_subscripts(pieces, 1) - 1 AS i
    FROM cut WHERE len(pieces) > 1
), placed AS (
    SELECT *, length(piece) AS size, coalesce(sum(length(piece)) OVER (
        PARTITION BY doc_id, kind_no ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM pieces
), parts AS (
    SELECT doc_id, kind_no, kind, role, start, start + size AS stop FROM placed
    WHERE i % 2 = 1 AND size >= least AND (most IS NULL OR size <= most)
        AND (kind <> 'assign' OR length(regexp_extract(piece, {text_of(BASE_KINDS['assign'][0])}, 2)) >= {LEAST_ASSIGNED})
), spans AS (
    SELECT * FROM parts WHERE kind_no < {n}
    UNION ALL
    SELECT * FROM parts w WHERE kind_no >= {n}
        AND EXISTS (SELECT 1 FROM parts p WHERE p.doc_id = w.doc_id AND (p.role = 'secret') <> (w.role = 'secret')
            AND p.start <= w.stop + {SCOPE} AND p.stop >= w.start - {SCOPE})
        AND NOT EXISTS (SELECT 1 FROM parts p WHERE p.doc_id = w.doc_id AND p.kind_no < {n}
            AND p.start < w.stop AND p.stop > w.start)
), joined AS (
    SELECT doc_id,
        count(*) FILTER (WHERE kind = 'assign') AS n_assign,
        count(*) FILTER (WHERE kind = 'access') AS n_access,
        count(*) FILTER (WHERE kind = 'hex') AS n_hex,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) FILTER (WHERE kind_no < {n}) AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) AS spans
    FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN joined USING (doc_id)
"""
