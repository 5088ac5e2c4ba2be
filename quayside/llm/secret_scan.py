"""Find secrets in texts, and link weaker parts of multipart credentials.

Three strong patterns stand by themselves. A bare random-looking token or a login name is weak:
it is reported only where parts that complete it stand near, that is, for a token an access
identifier or a login within the scope, or an endpoint; for a login, a secret and an endpoint.
Parts are joined by interval: scopes are laid over buckets of the text, each bucket keeps the
first and last part of a kind, and a part looks into its own bucket and the two beside it. That
settles every distance up to the scope exactly, and no pairs of parts are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import whole_text, written

# Fixed patterns and least lengths; kinds in the order of spans that begin together.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the same as runs of any length that have 24 characters or more
KINDS = ("assign", "access", "hex", "weak_secret", "weak_login")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
# Weak parts.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{32,}+"
LOGIN = r"""(?i:user(?:name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
ENDPOINT = r"""(?:https?|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9.-]+|(?i:endpoint|host(?:name)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+"""
SCOPE = 400  # characters between the starts of parts that belong together
REDACTED = "[SECRET]"
SPAN = "array<struct<start:bigint,kind:int,stop:bigint>>"


def _running(values: Column) -> Column:
    """Running totals of an array before each value, in n * sqrt(n) steps: by blocks, then within."""

    def before(array: Column, first: Column) -> Column:
        """[first, first + a0, first + a0 + a1, ...], one longer than the array."""
        return F.aggregate(
            array,
            F.array(first),
            lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)),
        )

    size = F.size(values)
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(size)).cast("int"))
    starts = F.when(size > 0, F.sequence(F.lit(1), size, width)).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda s: F.slice(values, s, width))
    sums = F.transform(
        blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda total, x: total + x)
    )
    firsts = before(sums, F.lit(0).cast("long"))
    inner = F.zip_with(
        blocks,
        firsts,
        lambda b, first: F.when(b.isNotNull(), F.slice(before(b, first), F.lit(1), F.size(b))).otherwise(
            F.array().cast("array<long>")
        ),
    )
    return F.flatten(inner)


def _spans(found: str, between: str, kind: int) -> Column:
    """Spans from the matches of a pattern and the pieces between them, in code points."""
    gaps = F.transform(F.slice(F.col(between), F.lit(1), F.size(found)), lambda p: F.length(p).cast("long"))
    sizes = F.transform(F.col(found), lambda m: F.length(m).cast("long"))
    steps = F.zip_with(gaps, sizes, lambda gap, size: gap + size)
    spans = F.zip_with(
        F.zip_with(_running(steps), gaps, lambda total, gap: total + gap),
        sizes,
        lambda start, size: F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + size).alias("stop")),
    )
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(SPAN)).cast(SPAN)


def parts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds assign_, access_, hex_, token_, login_ and endpoint_: arrays of spans by start."""
    text = whole_text(text_col)
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "token": TOKEN, "login": LOGIN, "endpoint": ENDPOINT}
    kind = {"assign": 0, "access": 1, "hex": 2, "token": 3, "login": 4, "endpoint": 5}
    frame = docs.withColumns(
        {f"{name}_found": F.regexp_extract_all(text, F.lit(p), 0) for name, p in patterns.items()}
        | {"assign_value": F.regexp_extract_all(text, F.lit(ASSIGN), 2)}
    )
    frame = frame.withColumns(
        {
            f"{name}_between": F.when(F.size(f"{name}_found") > 0, F.split(text, p, -1)).otherwise(
                F.array().cast("array<string>")
            )
            for name, p in patterns.items()
        }
    )
    frame = frame.withColumns({f"{name}_": _spans(f"{name}_found", f"{name}_between", kind[name]) for name in patterns})
    long_value = F.zip_with(
        "assign_", "assign_value", lambda span, value: F.when(F.length(value) >= LEAST_ASSIGN, span)
    )
    mixed = F.zip_with(
        "token_",
        "token_found",
        lambda span, m: F.when(m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]"), span),
    )
    return frame.withColumns(
        {
            "assign_": F.filter(long_value, lambda s: s.isNotNull()),
            "access_": F.filter("access_", lambda s: s["stop"] - s["start"] >= LEAST_ACCESS),
            "token_": F.filter(mixed, lambda s: s.isNotNull()),
        }
    ).drop(*(f"{name}_{part}" for name in patterns for part in ("found", "between")), "assign_value")


def _linkable() -> Column:
    """Whether a text has weak parts and any part that could complete them."""
    some = lambda name: F.size(f"{name}_") > 0
    token = some("token") & (some("access") | some("login") | some("endpoint"))
    login = some("login") & some("endpoint") & (some("assign") | some("hex") | some("token"))
    return token | login


def _linked(found: DataFrame, keys: list[str]) -> DataFrame:
    """keys and linked: the weak spans that complementary parts confirm."""
    rows = found.select(*keys, "token_", "login_", "access_", "endpoint_", "assign_", "hex_").distinct()
    role = lambda name, spans: F.transform(
        spans, lambda s: F.struct(F.lit(name).alias("role"), s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))
    )
    listed = F.concat(
        role("identifier", F.concat("access_", "login_")),
        role("endpoint", F.col("endpoint_")),
        role("secret", F.concat("assign_", "hex_", "token_")),
    )
    each = rows.select(*keys, F.explode(listed).alias("p")).select(
        *keys, "p.*", F.floor(F.col("p.start") / SCOPE).alias("bucket")
    )
    edges = each.groupBy(*keys, "bucket", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    # A bucket shows its parts to itself and to its neighbours.
    shown = edges.select(
        *keys,
        F.explode(F.array(*(F.struct((F.col("bucket") + d).alias("b"), F.lit(d).alias("d")) for d in (-1, 0, 1)))).alias("x"),
        "role",
        "first",
        "last",
    ).select(*keys, F.col("x.b").alias("bucket"), F.col("x.d").alias("d"), "role", "first", "last")
    seen = shown.groupBy(*keys, "bucket").agg(
        *(
            pick("first" if d == -1 else "last", (F.col("role") == role_) & (F.col("d") == d)).alias(f"{role_}_{name}")
            for role_ in ("identifier", "endpoint", "secret")
            for d, name, pick in (
                (-1, "next", lambda c, when: F.min(F.when(when, F.col(c)))),
                (0, "here", lambda c, when: F.max(F.when(when, F.col(c)))),
                (1, "before", lambda c, when: F.max(F.when(when, F.col(c)))),
            )
        )
    )
    near = lambda role_: (
        F.col(f"{role_}_here").isNotNull()
        | F.coalesce(F.col(f"{role_}_next") - F.col("start") <= SCOPE, F.lit(False))
        | F.coalesce(F.col("start") - F.col(f"{role_}_before") <= SCOPE, F.lit(False))
    )
    weak = each.where(F.col("kind").isin(3, 4)).join(seen, [*keys, "bucket"])
    confirmed = weak.where(
        ((F.col("kind") == 3) & (near("identifier") | near("endpoint")))
        | ((F.col("kind") == 4) & near("secret") & near("endpoint"))
    )
    return confirmed.groupBy(*keys).agg(F.collect_set(F.struct("start", "kind", "stop")).cast(SPAN).alias("linked"))


def scanned(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """kept_row (all columns, or those in `carry`), base_spans and spans (start, kind, stop; sorted).

    A null text counts as empty and has none. Rows are never merged: equal rows have equal
    spans each. Only texts that hold complementary parts go through the join, as spans without
    their text; they are found again by a row number.
    """
    names = docs.columns if carry is None else carry
    frame = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("kept_row"), F.col(f"`{text_col}`").alias("text")
    )
    found = written(parts(frame).drop("text").withColumn("row", F.monotonically_increasing_id()), "secret-parts")
    base = F.array_sort(F.concat("assign_", "access_", "hex_"))
    plain = found.where(~_linkable()).select("kept_row", base.alias("base_spans"), base.alias("spans"))
    some = found.where(_linkable())
    linked = (
        some.join(_linked(some.drop("kept_row"), ["row"]), ["row"], "left")
        .withColumn("base_spans", base)
        .withColumn("linked", F.coalesce("linked", F.array().cast(SPAN)))
        # A weak part inside a base span is already reported.
        .withColumn(
            "linked",
            F.filter(
                "linked",
                lambda w: ~F.exists("base_spans", lambda b: (b["start"] < w["stop"]) & (w["start"] < b["stop"])),
            ),
        )
        .select("kept_row", "base_spans", F.array_sort(F.concat("base_spans", "linked")).alias("spans"))
    )
    return plain.unionByName(linked)


def as_text(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base_sha256 and spans of every row."""
    of_kind = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    # Only the id travels with the spans.
    found = scanned_ids(docs)
    return found.select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(as_text("base_spans"), 256).alias("base_sha256"),
        as_text("spans").alias("spans"),
    )


def scanned_ids(docs: DataFrame) -> DataFrame:
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scanned(asked, "text", ("doc_id",)).select("kept_row.doc_id", "base_spans", "spans")


def redacted(docs: DataFrame) -> DataFrame:
    """All documents, each run of overlapping spans replaced by REDACTED."""
    text = F.col("kept_row")["text"]
    # Cut points come from merged spans: a span reaches to the end of those it overlaps.
    merged = F.aggregate(
        "spans",
        F.array().cast("array<struct<start:bigint,stop:bigint>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] < F.element_at(done, -1)["stop"]),
            F.concat(
                F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["stop"], s["stop"]).alias("stop"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))),
    )
    cut = F.col("cuts_")
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(cut)),
        lambda i: F.substring(
            text,
            (F.coalesce(F.get(cut, i - 1)["stop"], F.lit(0)) + 1).cast("int"),
            (
                F.coalesce(F.get(cut, i)["start"], F.length(text).cast("long"))
                - F.coalesce(F.get(cut, i - 1)["stop"], F.lit(0))
            ).cast("int"),
        ),
    )
    found = scanned(docs).withColumn("cuts_", merged)
    clean = F.when(F.size("spans") > 0, F.array_join(pieces, REDACTED)).otherwise(text)
    return found.withColumn("clean_", clean).select(
        *(F.col("clean_").alias("text") if c == "text" else F.col("kept_row")[c].alias(c) for c in docs.columns)
    )
