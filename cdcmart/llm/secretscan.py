"""Secret scans with corpus-wide ownership: DataFrame operations only.

Three kinds of candidates are found in every text. The value of each candidate is hashed, and the hashes are counted
over the corpus by distinct repositories and distinct owners. A value that more than ``max_owners`` owners or more
than ``max_repositories`` repositories have is a copied example: a credential is reused in some repositories of its
owner, not in hundreds, so one large owner does not turn an example into a secret. Any other value that looks like a
credential gets a span of its own, kind ``live``, beside the candidate's span.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import free_name, quoted, run_folder, saved

# The kinds in their order, pattern and least length (of group 2 for the first kind).
KINDS = ("assign", "access", "hex", "live")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

# The same matches as above once those that are too short are dropped: a run that is too short from its
# begin has no longer match inside.
_LONG_ACCESS = r"AKIA[A-Z0-9]{16,}"
_LONG_HEX = r"[0-9a-f]{24,}"

# Owners and repositories up to which a value counts as owner-specific, and letters from which it looks live.
MAX_OWNERS = 1
MAX_REPOSITORIES = 100
LEAST_LIVE = 16


_NO_SPANS = "cast(array() as array<struct<start:int,end:int,kind:int,value:string>>)"

# Elements that a running sum is built up from at once: an array grows by copying, so it has to stay short.
_STRETCH = 256


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(lengths: Column) -> Column:
    """For each element the sum of those before it: first within stretches, then over the stretches."""
    grown = lambda d, x: F.struct((d["sum"] + x).alias("sum"), F.concat(d["before"], F.array(d["sum"])).alias("before"))
    nothing = F.expr("struct(0 as sum, cast(array() as array<int>) as before)")
    last = F.floor((F.size(lengths) - 1) / _STRETCH).cast("int")
    stretches = F.transform(
        F.sequence(F.lit(0), last),
        lambda k: F.aggregate(F.slice(lengths, k * _STRETCH + 1, _STRETCH), nothing, grown),
    )
    return _with(
        stretches,
        lambda parts: F.flatten(
            F.zip_with(
                parts,
                F.aggregate(parts, nothing, lambda d, x: grown(d, x["sum"]), lambda d: d["before"]),
                lambda part, base: F.transform(part["before"], lambda x: x + base),
            )
        ),
    )


def _matches(text: Column, pattern: str, hint: Column, kind: str, group: int = 0) -> Column:
    """Spans of all matches: begin and end in characters, and value. The texts between the matches give the positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.split(text, pattern, -1)
    parts = F.arrays_zip(between.alias("gap"), found.alias("match"), values.alias("value"))
    sized = F.transform(
        parts,
        lambda p: F.struct(
            F.char_length(p["gap"]).alias("gap"), F.coalesce(F.char_length(p["match"]), F.lit(0)).alias("match"), p["value"].alias("value")
        ),
    )

    def placed(sizes: Column) -> Column:
        before = _with(F.transform(sizes, lambda s: s["gap"] + s["match"]), _running)
        spans = F.zip_with(
            sizes,
            before,
            lambda s, at: F.struct(
                (at + s["gap"]).alias("start"),
                (at + s["gap"] + s["match"]).alias("end"),
                F.lit(KINDS.index(kind)).alias("kind"),
                s["value"].alias("value"),
            ),
        )
        # What follows the last match is no match.
        return F.slice(spans, F.lit(1), F.size(spans) - 1)

    return F.when(hint, _with(sized, placed)).otherwise(F.expr(_NO_SPANS))


def base_spans(text: Column) -> Column:
    """All candidates of a text, ordered by begin, then kind: array of (start, end, kind, value)."""
    text = F.coalesce(text, F.lit(""))
    assign = F.filter(
        _matches(text, ASSIGN, text.rlike(ASSIGN), "assign", 2), lambda s: F.char_length(s["value"]) >= LEAST["assign"]
    )
    access = _matches(text, _LONG_ACCESS, text.contains("AKIA"), "access")
    hexes = _matches(text, _LONG_HEX, text.rlike(_LONG_HEX), "hex")
    by_place = lambda a, b: (
        F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"])
    )
    return F.array_sort(F.concat(assign, access, hexes), by_place)


def value_places(span: Column) -> Column:
    """Where the value of a span begins: values stand at the end of their match."""
    return span["end"] - F.char_length(span["value"])


def live_looking(value: Column) -> Column:
    """Long enough, and both letters and digits."""
    return (F.char_length(value) >= LEAST_LIVE) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Add ``spans`` to every row: array of (start, end, kind, value), by begin, then kind as in ``KINDS``.

    ``start`` and ``end`` count code points. Kind ``live`` marks the value of a candidate that at most
    ``max_owners`` owners and ``max_repositories`` repositories have in the whole table (a null owner is an owner of its
    own, and so is a null repository; one id under two owners is two repositories) and that looks like a credential.
    Null and empty texts have no spans. Rows are kept as they are, repeated ones too; a column named ``spans``
    gives way (see ``free_name``).
    """
    folder = run_folder(docs.sparkSession, "secrets")
    found = _with_live(_found(docs, text, folder), owner, repository, max_owners, max_repositories, folder)
    return found.select("doc.*", F.col("spans").alias(free_name(docs, "spans")))


def _found(docs: DataFrame, text: str, folder: str) -> DataFrame:
    """doc (a row of ``docs`` as one column, so that none of its names meets another), row_id and spans of every row.

    Scanned once and written: the ids of the rows have to stay the same for the joins to come.
    """
    doc = F.struct(*quoted(docs.columns)).alias("doc")
    spans = base_spans(F.col(*quoted([text]))).alias("spans")
    return saved(docs.select(doc, F.monotonically_increasing_id().alias("row_id"), spans), folder, "base")


def _single_spans(some: DataFrame, owner: str, repository: str) -> DataFrame:
    doc = F.col("doc")
    return some.select(
        "row_id",
        doc.getField(owner).alias("owner"),
        doc.getField(repository).alias("repository"),
        F.explode("spans").alias("span"),
    ).withColumn("hash", F.sha2("span.value", 256))


def _counted(single: DataFrame) -> DataFrame:
    """Distinct owners and repositories of every value."""
    # Copies of one value in one repository, then repositories of one owner, are merged before they are shuffled on.
    by_repository = single.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def _copied(max_owners: int, max_repositories: int) -> Column:
    """Whether a counted value is a copied example."""
    return (F.col("owners") > max_owners) | (F.col("repositories") > max_repositories)


def _with_live(
    found: DataFrame, owner: str, repository: str, max_owners: int, max_repositories: int, folder: str
) -> DataFrame:
    """doc and spans, live ones included."""
    none, some = found.where(F.size("spans") == 0), found.where(F.size("spans") > 0)
    single = _single_spans(some, owner, repository)
    owned = _counted(single.where(live_looking(F.col("span.value"))))
    live = saved(owned.where(~_copied(max_owners, max_repositories)).select("hash"), folder, "live")
    added = (
        single.join(live, "hash")
        .select(
            "row_id",
            F.struct(
                value_places(F.col("span")).alias("start"),
                F.col("span.end").alias("end"),
                F.lit(KINDS.index("live")).alias("kind"),
                F.col("span.value").alias("value"),
            ).alias("span"),
        )
        .groupBy("row_id")
        .agg(F.collect_set("span").alias("added"))
    )
    by_place = lambda a, b: (
        F.when(a["start"] != b["start"], a["start"] - b["start"])
        .when(a["kind"] != b["kind"], a["kind"] - b["kind"])
        .otherwise(a["end"] - b["end"])
    )
    merged = F.array_sort(F.concat("spans", F.coalesce("added", F.slice("spans", 1, 0))), by_place)
    joined = some.join(added, "row_id", "left").select("doc", merged.alias("spans"))
    return none.select("doc", "spans").unionByName(joined)


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_live of every document. Null texts have no spans; rows
    with a null doc_id and repeated rows each get their result; other columns are not read."""
    folder = run_folder(docs.sparkSession, "secrets")
    # The texts are not written again: only ids, owners and spans.
    doc = F.struct("doc_id", "source").alias("doc")
    base = docs.select(doc, F.monotonically_increasing_id().alias("row_id"), base_spans(F.col("text")).alias("spans"))
    all_spans = _with_live(saved(base, folder, "base"), "source", "doc_id", MAX_OWNERS, MAX_REPOSITORIES, folder)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    live = KINDS.index("live")
    return all_spans.select(
        "doc.doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_listed(F.filter("spans", lambda s: s["kind"] != live)), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        count("live").alias("n_live"),
    )


def _without_copied(docs: DataFrame) -> DataFrame:
    """doc and spans of every row: the base spans, but those whose value is a copied example."""
    folder = run_folder(docs.sparkSession, "secrets")
    found = _found(docs, "text", folder)
    none, some = found.where(F.size("spans") == 0), found.where(F.size("spans") > 0)
    single = _single_spans(some, "source", "doc_id")
    copied = saved(_counted(single).where(_copied(MAX_OWNERS, MAX_REPOSITORIES)).select("hash"), folder, "copied")
    left_out = single.join(copied, "hash").groupBy("row_id").agg(F.collect_set("span.value").alias("examples"))
    kept = F.filter("spans", lambda s: ~F.coalesce(F.array_contains("examples", s["value"]), F.lit(False)))
    joined = some.join(left_out, "row_id", "left").select("doc", kept.alias("spans"))
    return none.select("doc", "spans").unionByName(joined)


def masked(docs: DataFrame, mask: str = "[secret]", keep_copied: bool = False) -> DataFrame:
    """The rows of ``docs`` with the text of every base span, overlapping ones as one, replaced by ``mask`` and
    ``n_chars`` counted again; texts without spans stay as they are.

    With ``keep_copied``, ownership decides: a span whose value is a copied example stays in the text. All others
    are masked: live ones with the key before them, and those of one owner that do not look like a credential."""
    # A live span lies in its base span: without the counts there is nothing more to mask.
    if keep_copied:
        found = _without_copied(docs)
    else:
        doc = F.struct(*quoted(docs.columns)).alias("doc")
        found = docs.select(doc, base_spans(F.col("text")).alias("spans"))
    changed = F.size("spans") > 0
    text = F.when(changed, _cut(F.col("doc.text"), F.col("spans"), mask)).otherwise(F.col("doc.text"))
    found = found.select("doc", "spans", text.alias("masked"))
    length = F.when(changed, F.char_length("masked").cast("long")).otherwise(F.col("doc").getField("n_chars"))
    new = {"text": F.col("masked"), "n_chars": length}
    return found.select(*[(new[c] if c in new else F.col("doc").getField(c)).alias(c) for c in docs.columns])


def _cut(text: Column, spans: Column, mask: str) -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mask``."""
    # A span that begins before the last one has ended belongs to it.
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda done, s: F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(
                (s["start"] >= done["at"]),
                F.concat(done["out"], text.substr(done["at"] + 1, s["start"] - done["at"]), F.lit(mask)),
            )
            .otherwise(done["out"])
            .alias("out"),
        ),
        lambda done: F.concat(done["out"], text.substr(done["at"] + 1, F.char_length(text) - done["at"])),
    )
