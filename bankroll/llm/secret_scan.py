"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Every text is searched for the base kinds (assign, access, hex) and for the added ones
(vendor, pem, urlauth). Each candidate's value is hashed, and the hashes are counted by
distinct owners and distinct repositories over the whole corpus: a value that several
owners carry is a copied example, one that stays with one owner and does not look like a
placeholder is a live-looking credential.

Spans are code-point offsets into the whole text, end exclusive. They come from the
lengths of the parts around the matches (``split``) and of the matches themselves, summed
by a window over each text.

Cases: a null text is empty. Null owners and repositories are one owner and one
repository of their own. Repeated rows are scanned and reported one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

# Kinds in their order, pattern, group that holds the value, least characters of it
BASE_KINDS = (
    ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
               r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 18),
    ("hex", r"([0-9a-f]{16,})", 1, 16),
)
ADDED_KINDS = (
    ("vendor", r"(gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{20,}|AIza[A-Za-z0-9_-]{35}"
               r"|sk_live_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})", 1, 1),
    # the value is the body up to its END line, or else its lines of base64; the header alone has none
    ("pem", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)([^-]*(?:-[^-]+){0,24}?-----END [A-Z ]*PRIVATE KEY-----"
            r"|[\t\n\r\x20]*(?:[A-Za-z0-9-]+:\x20[^\r\n]*[\r\n]+){0,8}"
            + 4 * r"(?:[\t\n\r\x20\\]*[A-Za-z0-9+/=]{16,}){0,60}" +  # 240 lines hold 16,384 bits
            r"(?:[\r\n\\]+[A-Za-z0-9+/=]{1,15})?)", 2, 0),
    ("urlauth", r"([a-z][a-z0-9+.-]{1,20}://[^\x00-\x20:/@\"']{1,64}:)([^\x00-\x20:/@\"']{6,128})@", 2, 6),
)
KINDS = BASE_KINDS + ADDED_KINDS
COPIED_OWNERS = 2       # a value with at least so many owners is a copied example
COPIED_REPOSITORIES = 4  # or with so many repositories
LIVE_CHARACTERS = 8     # a live-looking value has at least so many distinct characters
PLACEHOLDER = r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd]|[Cc][Hh][Aa][Nn][Gg][Ee][_-]?[Mm][Ee]|[Yy][Oo][Uu][Rr][_-]|[Xx]{6}|[Dd][Uu][Mm][Mm][Yy]"
# Masking leaves a value in clear only as a widely copied one or as a repetitive one
WIDE_OWNERS, WIDE_TEXTS = 5, 10  # least owners, each distinct text voting for one, and distinct texts
REPETITIVE = 0.25       # of the distinct characters that a random value of its length and alphabet has
MASKS_BROADCAST = 500_000  # texts to mask; beyond it they are joined by a shuffle


def _found(text: Column) -> Column:
    """The kinds that occur in a text: number of the kind, lengths of the parts around its
    matches, the matches and their values."""
    each = []
    for k, (_, pattern, group, _least) in enumerate(KINDS):
        p = F.lit(pattern)
        each.append(F.when(text.rlike(pattern), F.struct(
            F.lit(k).alias("k"),
            F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
            F.transform(F.regexp_extract_all(text, p, F.lit(0)), F.length).alias("sizes"),
            F.regexp_extract_all(text, p, F.lit(group)).alias("values"))))
    return F.array_compact(F.array(*each))


def _spans(scan: DataFrame, *more: str) -> DataFrame:
    """One row per span: (row, owner, repository, *more, k, start, end, value, hash)."""
    own = ["row", "owner", "repository", *more]
    each = (scan.select(*own, F.explode("found").alias("f"))
            .select(*own, "f.k", F.posexplode(F.arrays_zip("f.gaps", "f.sizes", "f.values")).alias("at", "m"))
            .select(*own, "k", "at", "m.gaps", "m.sizes", "m.values")
            .filter(F.col("values").isNotNull()))
    so_far = Window.partitionBy("row", "k").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gaps") + F.col("sizes")).over(so_far)
    least = F.element_at(F.array(*[F.lit(kind[3]) for kind in KINDS]), F.col("k") + 1)
    return (each.withColumn("end", end).withColumn("start", F.col("end") - F.col("sizes"))
            .filter(F.length("values") >= least)
            .select(*own, "k", "start", "end", F.col("values").alias("value"), F.sha2("values", 256).alias("hash")))


def _ownership(spans: DataFrame) -> DataFrame:
    """(hash, owners, repositories): distinct ones over the whole corpus. The distinct rows
    are formed before the shuffle, so a value that very many rows carry stays small."""
    seen = spans.select("hash", "owner", "repository").distinct()
    owners = seen.select("hash", "owner").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("owners"))
    repos = (seen.select("hash", "owner", "repository").groupBy("hash")
             .agg(F.count(F.lit(1)).alias("repositories")))
    return owners.join(repos, "hash")


def _judged(spans: DataFrame) -> DataFrame:
    copied = (F.col("owners") >= COPIED_OWNERS) | (F.col("repositories") >= COPIED_REPOSITORIES)
    plain = F.col("value").rlike(PLACEHOLDER) | (
        F.size(F.array_distinct(F.split("value", ""))) < LIVE_CHARACTERS)
    verdict = F.when(copied, "copied").when(plain, "placeholder").otherwise("live")
    return spans.join(_ownership(spans), "hash").withColumn("verdict", verdict)


def _repetitive(value: Column) -> Column:
    """Whether a value has far fewer distinct characters than a random one of its length over
    its alphabet would have; a blank one is."""
    value = F.btrim(value, F.lit(" \t\r\n"))
    has = lambda p, n: F.when(value.rlike(p), n).otherwise(0)
    letters = (F.when(value.rlike("^[0-9]+$"), 10).when(value.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16)
               .otherwise(has("[0-9]", 10) + has("[a-z]", 26) + has("[A-Z]", 26) + has("[^0-9A-Za-z]", 4)))
    usual = letters * (1 - F.pow(1 - 1 / F.greatest(letters, F.lit(1)), F.length(value)))
    return (F.length(value) == 0) | (F.size(F.array_distinct(F.split(value, ""))) < REPETITIVE * usual)


def _to_mask(scan: DataFrame) -> DataFrame:
    """The spans of the values that must not stay in clear. Copies of one text are one text,
    of one owner, so they do not make a value widely copied."""
    spans = _spans(scan, "t1", "t2").filter(~F.col("value").rlike(PLACEHOLDER) & ~_repetitive(F.col("value")))
    texts = spans.groupBy("hash", "t1", "t2").agg(F.min("owner").alias("owner"))
    wide = (texts.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("texts"))
            .filter((F.col("owners") >= WIDE_OWNERS) & (F.col("texts") >= WIDE_TEXTS)).select("hash"))
    return spans.join(wide, "hash", "left_anti")


def _names(spans: Column) -> Column:
    kind = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kind, s["k"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def _scanned(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str,
             *more: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return written(docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(owner_col), F.lit("")).alias("owner"),
        F.coalesce(F.col(repo_col), F.lit("")).alias("repository"), _found(text).alias("found"), *more)
        .withColumn("row", F.monotonically_increasing_id()), "secrets-scan")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 owner_col: str = "source", repo_col: str = "source") -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans, found, n_live, n_copied,
    n_placeholder): one row per row of ``docs``. ``found`` holds each span's kind, place,
    value hash, owners, repositories and verdict."""
    scan = _scanned(docs, id_col, text_col, owner_col, repo_col)
    judged = _judged(_spans(scan))
    kind = F.array(*[F.lit(k[0]) for k in KINDS])
    count = lambda c: F.count(F.when(c, 1))
    per_row = judged.groupBy("row").agg(
        *[count(F.col("k") == k).alias(f"n_{KINDS[k][0]}") for k in range(3)],
        *[count(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "copied", "placeholder")],
        F.sort_array(F.collect_list(F.struct("start", "k", "end", "hash", "owners", "repositories",
                                             "verdict"))).alias("s"))
    none = F.array().cast("array<struct<start:bigint,k:int,end:bigint,hash:string,owners:bigint,"
                          "repositories:bigint,verdict:string>>")
    counts = ["n_assign", "n_access", "n_hex", "n_live", "n_copied", "n_placeholder"]
    out = (scan.select("row", "id").join(per_row, "row", "left").withColumn("s", F.coalesce("s", none)))
    return out.select(
        F.col("id").alias(id_col), *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.sha2(_names(F.filter("s", lambda x: x["k"] < len(BASE_KINDS))), 256).alias("base_sha256"),
        _names(F.col("s")).alias("spans"),
        F.transform("s", lambda x: F.struct(
            F.element_at(kind, x["k"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            x["hash"].alias("hash"), x["owners"].alias("owners"),
            x["repositories"].alias("repositories"), x["verdict"].alias("verdict"))).alias("found"))


def _text_key(text_col: str) -> list[Column]:
    text = F.col(text_col)
    return [F.xxhash64(text).alias("t1"), F.md5(text.cast("binary")).alias("t2")]


def mask_live(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              owner_col: str = "source", repo_col: str = "source", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with each live-looking value's span replaced by ``mask`` (overlapping spans
    by one); other rows and columns stay as they are. Stricter than the verdicts of
    ``scan_secrets``: a value stays in clear only if it is a placeholder by its characters or
    many owners carry it in many distinct texts."""
    scan = _scanned(docs, id_col, text_col, owner_col, repo_col, *_text_key(text_col))
    live = _to_mask(scan).select("row", "start", "end")
    # spans that overlap become one: a span begins where none before it reaches
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    runs = Window.partitionBy("row").orderBy("start", "end")
    live = live.withColumn("new", F.when(F.col("start") <= F.max("end").over(before), 0).otherwise(1))
    live = live.withColumn("run", F.sum("new").over(runs)).groupBy("row", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    marks = (live.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("marks"))
             .join(scan.select("row", "t1", "t2"), "row").groupBy("t1", "t2")
             .agg(F.first("marks").alias("marks")))
    marks = written(marks, "secrets-marks")
    side = F.broadcast(marks) if marks.count() <= MASKS_BROADCAST else marks
    keyed = docs.select(*docs.columns, *[k.alias(f"__{n}") for n, k in zip(("t1", "t2"), _text_key(text_col))])
    out = keyed.join(side.toDF("__m1", "__m2", "__marks"), (F.col("__t1") == F.col("__m1"))
                     & (F.col("__t2") == F.col("__m2")), "left")
    m, text = F.col("__marks"), F.col(text_col)
    # the parts before, between and after the marks
    parts = F.transform(F.sequence(F.lit(0), F.size(m)), lambda i: F.substring(
        text, F.when(i == 0, F.lit(0)).otherwise(F.get(m, i - 1)["end"]).cast("int") + 1,
        (F.when(i == F.size(m), F.length(text)).otherwise(F.get(m, i)["start"])
         - F.when(i == 0, F.lit(0)).otherwise(F.get(m, i - 1)["end"])).cast("int")))
    masked = F.when(m.isNull(), text).otherwise(F.concat_ws(mask, parts))
    return out.withColumn(text_col, masked).select(*docs.columns)
