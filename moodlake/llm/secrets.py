"""Secret scan: patterns on whole texts, and weak candidates that only count beside their complement.

Base kinds are reported wherever they match. Weak kinds (user names, short keys,
short hexadecimal strings, endpoints) are everyday text by themselves; they are
reported only where a complementary part lies within the same scope of
``SCOPE`` code points: an identifier or endpoint beside a secret, a secret
beside an identifier or endpoint. The parts of a document meet by an interval join:
equal document and cell of the text, then the distance is checked. A cell
holds few parts by its length, so a document full of parts makes no large join.

Everything is DataFrame expressions. A text is split by each pattern, so the
lengths of the pieces give the positions; running sums over a document's matches
turn them into offsets in code points. Texts are not shuffled for finding.

Defined results: NULL and empty texts have no spans; repeated rows are each
reported; other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import scratch_table

SCOPE = 200
MASK = "[SECRET]"
# Code points that a masked text is cut into.
PIECE = 1024


@dataclass(frozen=True)
class Kind:
    """A pattern, what it takes part as, and whether it counts by itself."""

    name: str
    pattern: str
    role: str
    strong: bool


ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST_ASSIGNED = 6
# The order breaks ties between spans with the same start. Runs are matched whole, so a lower bound in
# the pattern drops the same matches as a check of their length would.
KINDS = (
    Kind("assign", ASSIGN, "secret", True),
    Kind("access", r"AKIA[A-Z0-9]{16,}", "identifier", True),
    Kind("hex", r"[0-9a-f]{24,}", "secret", True),
    Kind("user", r"""\b(?i:user|username|user_id|login|client_id|account_id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", "identifier", False),
    Kind("weak_key", r"""\b(?i:pwd|pass|key|auth|bearer|private_key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}""", "secret", False),
    Kind("weak_hex", r"\b(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{16,23}\b", "secret", False),
    Kind("endpoint", r"""\b(?:https?|ftp|jdbc:[a-z]+|mongodb|redis|postgres(?:ql)?|mysql|amqp)://[A-Za-z0-9.:@/_-]{4,}""", "endpoint", False),
)


def scan(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``rid``, the struct ``row`` with the columns of ``docs`` (without the text if so asked), ``found``: matches by kind.

    Kept in the scratch folder, so that ``rid`` stays what it is when a task is repeated.
    """
    body = F.coalesce(F.col(text), F.lit(""))

    def matches(kind: Kind) -> Column:
        # Each array is made once and they are walked together: work grows with the text, not with text times matches.
        found = F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(0))
        second = F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(2)) if kind.name == "assign" else found
        both = F.arrays_zip(F.split(body, kind.pattern, -1).alias("gap"), found.alias("match"), second.alias("second"))
        # The piece after the last match has no match beside it.
        rows = F.transform(F.filter(both, lambda m: m["match"].isNotNull()), lambda m: F.struct(
            F.length(m["gap"]).cast("long").alias("gap"), F.length(m["match"]).cast("long").alias("length"),
            (F.length(m["second"]) >= LEAST_ASSIGNED if kind.name == "assign" else F.lit(True)).alias("valid"),
        ))
        return F.when(body.rlike(kind.pattern), rows).alias(kind.name)

    columns = [c for c in docs.columns if keep_text or c != text]
    found = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.struct(*columns).alias("row"), F.struct(*[matches(k) for k in KINDS]).alias("found")
    )
    return scratch_table(found, "secrets")


def parts(scanned: DataFrame) -> DataFrame:
    """``rid``, ``kind``, ``place`` (of the kind), ``role``, ``strong``, ``start``, ``end`` of every valid match."""
    each = None
    for place, kind in enumerate(KINDS):
        one = scanned.filter(F.col(f"found.{kind.name}").isNotNull()).select(
            "rid", F.lit(kind.name).alias("kind"), F.lit(place).alias("place"), F.lit(kind.role).alias("role"),
            F.lit(kind.strong).alias("strong"), F.posexplode(f"found.{kind.name}").alias("i", "m"),
        )
        each = one if each is None else each.unionByName(one)
    upto = F.sum(F.col("m.gap") + F.col("m.length")).over(Window.partitionBy("rid", "place").orderBy("i"))
    placed = each.withColumn("end", upto).withColumn("start", F.col("end") - F.col("m.length"))
    return placed.filter("m.valid").select("rid", "kind", "place", "role", "strong", "start", "end")


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The strong parts, and the weak ones with a complementary part within the scope and no strong one over them."""
    weak = found.filter("NOT strong")
    cells = F.array_distinct(F.flatten(F.array(*[
        F.array(*[F.floor(F.col(at) / scope) + d for d in (-1, 0, 1)]) for at in ("start", "end")
    ])))
    asking = weak.withColumn("cell", F.explode(cells)).alias("w")
    ends = F.array_distinct(F.array(*[F.floor(F.col(at) / scope) for at in ("start", "end")]))
    beside = found.withColumn("cell", F.explode(ends)).alias("p")
    near = (
        (F.col("w.rid") == F.col("p.rid")) & (F.col("w.cell") == F.col("p.cell"))
        & (F.col("p.start") <= F.col("w.end") + scope) & (F.col("p.end") >= F.col("w.start") - scope)
    )
    complement = (F.col("w.role") == "secret") != (F.col("p.role") == "secret")
    over = (F.col("p.start") < F.col("w.end")) & (F.col("p.end") > F.col("w.start"))
    told = asking.join(beside, near & complement & ~over, "left_semi").select(*found.columns).distinct()
    told = told.withColumn("cell", F.explode(cells)).alias("w")
    hidden = told.join(beside.filter("strong").alias("p"), near & over, "left_semi").select(*found.columns).distinct()
    keys = ["rid", "place", "start", "end"]
    kept = told.select(*found.columns).distinct().join(hidden.select(*keys), keys, "left_anti").select(*found.columns)
    return found.filter("strong").unionByName(kept)


def find(docs: DataFrame, text: str = "text", keep_text: bool = True, scope: int = SCOPE) -> DataFrame:
    """``row`` (the columns of ``docs``) and ``spans``: sorted array of struct(start, place, end, kind, strong, reach), where
    ``reach`` is how far the spans before it reach."""
    scanned = scan(docs, text, keep_text)
    found = scratch_table(parts(scanned.select("rid", "found")), "secret_parts")
    earlier = Window.partitionBy("rid").orderBy("start", "place", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = linked(found, scope).withColumn("reach", F.coalesce(F.max("end").over(earlier), F.lit(0).cast("long")))
    spans = reached.groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct("start", "place", "end", "kind", "strong", "reach"))).alias("spans")
    )
    empty = F.array().cast("array<struct<start:bigint,place:int,end:bigint,kind:string,strong:boolean,reach:bigint>>")
    return scanned.select("rid", "row").join(spans, "rid", "left").select("row", F.coalesce("spans", empty).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def strong_only(spans: Column | str = "spans") -> Column:
    return F.filter(spans, lambda s: s["strong"])


def redact(docs: DataFrame, text: str = "text", mask: str = MASK) -> DataFrame:
    """The documents with every span in the text replaced by ``mask``; overlapping spans by one."""
    found = find(docs, text)
    body = F.col(f"row.{text}")
    # Pieces of fixed length make it cheap to reach any place of a long text.
    pieces = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def between(held: Column, first: Column, last: Column) -> Column:
        """Characters from ``first`` up to ``last``, both from 0."""
        at = F.floor(first / PIECE).cast("int")
        wanted = F.slice(held, at + 1, F.greatest(F.floor((last - 1) / PIECE).cast("int") - at + 1, F.lit(0)))
        return F.substring(F.array_join(wanted, ""), (first - at * PIECE + 1).cast("int"), (last - first).cast("int"))

    # A span that begins before the reach of others only extends the mask before it.
    fresh = F.filter("spans", lambda s: s["start"] >= s["reach"])
    masked = F.transform(fresh, lambda s: F.concat(between(F.col("_pieces"), s["reach"], s["start"]), F.lit(mask)))
    end = F.array_max(F.transform("spans", lambda s: s["end"]))
    rest = between(F.col("_pieces"), end, F.length(body).cast("long"))
    clean = F.when(F.size("spans") == 0, body).otherwise(F.concat(F.array_join(masked, ""), rest))
    found = found.withColumn("_pieces", F.when(F.size("spans") > 0, pieces))
    return found.select(*[(clean if c == text else F.col(f"row.{c}")).alias(c) for c in docs.columns])
