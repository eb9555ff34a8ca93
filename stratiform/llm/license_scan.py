"""License scans by canonical digest lookup.

A text is reduced to a canonical form: lower case, without a title that only names the licence and
without copyright statements, equivalent spellings made one, everything between words one space. So
the form doesn't depend on how lines are wrapped. A statement begins a line and has (c), a sign or a
year; it ends with the line, with its sentence (not at an initial or 'Inc.'), or where a licence begins:
words between are taken for the holder's name. The digest of the whole form is looked up among the digests
of known licences by a hash join; so are the digests of a document's single lines, where notices
stand. A text with any other word in it is another text: nothing is matched in part.

Known licences are a small table. It is broadcast only if it has at most BROADCAST rows, and joined
by shuffle beyond that.

Defined cases. Null text, or text without words: no digest, no licence. Several licences with one
form: the first by name. Repeated rows: equal results. Extra columns aren't looked at. Very long texts are
reduced whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.license_texts import every, known
from stratiform.llm.tables import table

BROADCAST = 100_000

#: How a licence's own words begin, in lower case, and how a copyright statement does.
_OPENING = (
    r"permission\s+is\s+(?:hereby\s+)?granted|permission\s+to\s+use|redistribution\s+and\s+use|this\s+software\s+is\s+provided"
    r"|everyone\s+is\s+permitted\s+to\s+copy|licensed\s+under\s+the|this\s+(?:program|library)\s+is\s+free\s+software"
)
_SIGNED = r"(?:(?:copyright\s*(?:\(c\)|©|[12][0-9]{3})|\(c\)\s*(?:copyright|[12][0-9]{3})|©)(?!\s*(?:year\b|yyyy\b|_)))"
#: Statements known to the end: those left to fill in, and the Free Software Foundation's with its address.
_OPEN = (
    r"copyright\s*(?:\(c\)\s*)?(?:19yy|[<\[{](?:year|yyyy)[^>\]}]{0,20}[>\]}])\s*[<\[{][^>\]}]{1,60}[>\]}]"
    r"|copyright\s*(?:\(c\)|©)?\s*[0-9][0-9,\s]{3,60}free\s+software\s+foundation,\s+inc\.?,?|all\s+rights\s+reserved"
    r"|(?:51\s+franklin\s+st|59\s+temple\s+p|675\s+mass\s+ave)[^<>]{0,80}?usa\b|<https?://(?:www\.)?fsf\.org/?>"
)
_TITLE = (
    r"\A[^\p{L}\p{N}]*(?:the\s+)?(?:mit|expat|isc|zlib|(?:new|modified|simplified|[23]-clause)\s+bsd|bsd(?:\s+[23][\s-]clause)?)"
    r'(?:\s+"[a-z]+"(?:\s+or\s+"[a-z]+")?)?\s+licen[cs]e(?:\s*\((?:mit|expat|isc|zlib|bsd)(?:\s+licen[cs]e)?\))?'
    rf"(?=[^\p{{L}}\p{{N}}]*(?:{_SIGNED}|{_OPENING}))"
)
_STATEMENT = (
    rf"(?m)^[^\p{{L}}\p{{N}}\n]*(?:{_SIGNED}[^\n]*?(?:(?<!\b(?:inc|ltd|llc|corp|co|jr|sr|dr|\p{{L}}))\.(?=\s)|(?={_OPENING})|$)"
    r"[^\p{L}\p{N}\n]*)+"
)
#: Lines that state a copyright, as the SQL takes them: any that begin with the word.
COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
#: Spellings that mean the same, applied in order to the lower-case text.
SPELLINGS = [
    (r"licence", "license"),
    (r"sub-license", "sublicense"),
    (r"non-infringement", "noninfringement"),
    (r"merchantibility", "merchantability"),
    (r"gnu gpl", "gnu general public license"),
    (r"acknowledgement", "acknowledgment"),
    (r"https?://", ""),
    (r"&", " and "),
    (r"\bversion ([0-9])", "v$1"),
]


#: How patterns are written so that no match goes beyond its line.
_IN_LINE = [
    (r"\A", r"(?<![^\n])"), (r"\s", r"[^\S\n]"), (r"[^\p{L}\p{N}]", r"[^\p{L}\p{N}\n]"), (r"[^>\]}]", r"[^>\]}\n]"), ("[^<>]", r"[^<>\n]"),
]


def form_sql(text: str, of_lines: bool = False) -> str:
    """The canonical form as Spark's SQL, or the forms of all lines, with line feeds between."""
    out = f"lower({text})"
    spellings = [(pattern.replace(" ", r"\s+"), into) for pattern, into in SPELLINGS]
    for pattern, into in [(_OPEN, " "), (_TITLE, " "), (_STATEMENT, " "), *spellings, (r"[^\p{L}\p{N}]+", " ")]:
        for plain, kept in _IN_LINE if of_lines else []:
            pattern = pattern.replace(plain, kept)
        quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
        out = f"regexp_replace({out}, '{quoted}', '{into}')"
    return out if of_lines else f"trim({out})"


def canonical_sql(text: str, group: str = "$", every: str = "") -> str:
    """The form of the SQL, where every line that begins with 'copyright' goes; ``group`` and ``every``
    are how an engine writes a group in a replacement and that all matches are meant."""
    out = f"lower({text})"
    for pattern, into in [(COPYRIGHT, " "), *SPELLINGS, (r"[^\p{L}\p{N}]+", " ")]:
        quoted = pattern.replace("'", "''")
        out = f"regexp_replace({out}, '{quoted}', '{into.replace('$', group)}'{every})"
    return f"trim({out})"


def _digest(text: str) -> str:
    return f"sha2(nullif({form_sql(text)}, ''), 256)"


def _line_digests(text: str) -> str:
    return f"transform(split({form_sql(text, True)}, '\\n'), line -> sha2(nullif(trim(line), ''), 256))"


def licences(spark: SparkSession, texts: DataFrame | list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, licence): one row for each canonical form of the known texts; ``texts`` is a table
    (licence, text) or a list, to be known instead of the texts of this package."""
    given = texts if isinstance(texts, DataFrame) else spark.createDataFrame(every() if texts is None else texts, "licence string, text string")
    forms = given.select(F.expr(_digest("text")).alias("digest"), "licence").filter("digest is not null")
    return forms.groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """(doc_id, text_digest, licence, notices) of every row of ``docs`` (doc_id, text); ``notices`` are
    the licences of single lines, in order, with commas between."""
    small = registry.limit(BROADCAST + 1).count() <= BROADCAST
    held = F.broadcast(registry) if small else registry
    # a row is known by its doc_id and the hash of its text; digests of lines are made as one array, so
    # that no filter on them makes them again
    row = F.xxhash64("text").alias("row")
    lines = docs.select("doc_id", row, F.expr(_line_digests("text")).alias("lines"))
    found = (
        lines.select("doc_id", "row", F.explode("lines").alias("digest"))
        .join(held, "digest")
        .groupBy("doc_id", "row")
        .agg(F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("notices"))
    )
    whole = docs.select("doc_id", row, F.expr(_digest("text")).alias("text_digest"))
    whole = whole.join(held.withColumnRenamed("digest", "text_digest"), "text_digest", "left")
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("doc_id", "row")]
    joined = whole.alias("w").join(found.alias("n"), same, "left")
    return joined.select("w.doc_id", "w.text_digest", "w.licence", F.coalesce("n.notices", F.lit("")).alias("notices"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), licences(spark))


def oracle_sql() -> str:
    """The scan in DuckDB's SQL."""

    def digest(text: str) -> str:
        return f"sha256(nullif({canonical_sql(text, chr(92), ', ' + repr('g'))}, ''))"

    quote = "''"
    values = ", ".join(f"('{licence}', '{text.replace(chr(39), quote)}')" for licence, text in known())
    return f"""
        WITH given(licence, text) AS (VALUES {values}),
        registry AS (SELECT {digest("text")} AS digest, min(licence) AS licence FROM given GROUP BY 1),
        whole AS (SELECT doc_id, {digest("text")} AS text_digest, text FROM documents),
        lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM whole WHERE text_digest IS NOT NULL),
        found AS (
            SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
            FROM lines JOIN registry ON {digest("line")} = digest GROUP BY doc_id
        )
        SELECT whole.doc_id, text_digest, registry.licence, coalesce(notices, '') AS notices
        FROM whole LEFT JOIN registry ON text_digest = digest LEFT JOIN found ON found.doc_id = whole.doc_id
    """
