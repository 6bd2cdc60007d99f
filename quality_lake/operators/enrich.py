"""Context enrichment: left joins of a fact table to small context tables.

A context is broadcast only behind a check of its *measured* size: exact rows and
bytes of the columns that the join uses.  Beyond the limits, or when asked, the
join is a shuffle join with the same result, in which only those facts move that have to:

* a fact with a null key, or with a key whose hash no context key has (a bounded
  bitmap, see ``membership``), cannot match and keeps null context columns;
* a key that holds ``heavy_share`` of the facts or more (a frequent-items sketch of bounded
  size finds all of those) meets its context row by a broadcast of those rows
  alone, at most ``1 / heavy_share`` keys;
* the rest is sorted and merged.

Neither form reads a column that is not used after it, and nothing here collects
data to the driver but the heavy keys' hashes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import ContractError
from ..functions.timeops import local_hour_bucket
from ..sources.tables import stage
from .dedup import _comparable
from .keys import assert_unique_context_key
from .membership import bitmap_words, with_membership

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
#: A key with this share of the facts is joined by broadcast; the sketch that finds them tracks so many items.
HEAVY_SHARE, SKETCH_ITEMS = 0.01, 8192
# A broadcast row costs its values, 8 bytes for each of them and a row header.
_ROW_BYTES, _VALUE_BYTES = 24, 8


def _c(name: str):
    return F.col(f"`{name}`")


def value_bytes(schema: T.StructType):
    """Bytes of a row's values as a column: the text length of what varies in
    width (nested values as JSON), and nothing more than its slot otherwise."""
    fixed = _ROW_BYTES + _VALUE_BYTES * len(schema.fields)
    sized = [F.lit(fixed).cast("long")]
    for f in schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sized.append(F.octet_length(_c(f.name)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sized.append(2 * F.octet_length(F.to_json(F.struct(_c(f.name)))))
        elif isinstance(f.dataType, T.DecimalType):
            sized.append(F.lit(16))
    return reduce(lambda x, y: x + y, [F.coalesce(c, F.lit(0)) for c in sized])


def measure(df: DataFrame) -> tuple[int, int]:
    """Exact (rows, bytes of values) of a frame, as one observed result stage."""
    obs = Observation()
    (df.select(value_bytes(df.schema).alias("b"))
       .observe(obs, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"))
       .write.format("noop").mode("overwrite").save())
    return int(obs.get["rows"]), int(obs.get["bytes"])


def row_count(df: DataFrame) -> int:
    """Exact row count in one stage: an ``Observation`` on a ``noop`` write.

    ``count()`` (with or without a ``limit``) adds a shuffle, which AQE runs as a
    job of its own; the observed pass is a single result stage whose metric is
    applied once per task even when tasks are retried.  Columns nobody reads are
    pruned from the scan.
    """
    obs = Observation()
    (df.select().observe(obs, F.count(F.lit(1)).alias("rows"))
       .write.format("noop").mode("overwrite").save())
    return int(obs.get["rows"])


def broadcast_fits(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """Size check for a broadcast side: its measured rows and bytes must stay within both limits."""
    rows, size = measure(df)
    return rows <= max_rows and size <= max_bytes


def _key_map(keys) -> dict[str, str]:
    if isinstance(keys, dict):
        mapping = dict(keys)
    else:
        mapping = {k: k for k in keys}
    if not mapping:
        raise ContractError("Join keys must be nonempty")
    return mapping


def join_context(left: DataFrame, right: DataFrame, keys, columns, prefix: str,
                 broadcast: bool | None = None, *,
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                 max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                 size_ok: bool | None = None, marker: bool = False,
                 strategies: dict | None = None, heavy_share: float | None = HEAVY_SHARE,
                 member_filter: bool = True) -> DataFrame:
    """Left outer equi-join adding ``{prefix}_{column}`` for each context column.

    ``keys`` maps left key -> context key.  Null keys never match.  ``broadcast``
    True/None broadcast the context when it passes the size check; False joins by
    shuffle.  Both give the same rows.  The caller owns the row-count guarantee
    (see ``assert_unique_context_key``).  ``size_ok`` passes the result of a size
    check the caller already ran (see ``enrich``).  ``marker`` adds
    ``{prefix}_matched``: true exactly when a context row matched, also when the
    matched row's own columns are null.  ``strategies``, if given, receives
    ``prefix -> "broadcast"`` or ``"shuffle"``.

    In a shuffle join, ``heavy_share`` (None: off) and ``member_filter`` keep facts
    with heavy keys and facts without a match out of the shuffle (see above).  It reads
    ``left`` twice, and its keys once more for the sketch; stage a ``left`` that is
    expensive to make.
    """
    mapping = _key_map(keys)
    absent = sorted({*mapping} - {*left.columns}) + sorted({*mapping.values(), *columns} - {*right.columns})
    if absent:
        raise ContractError(f"{prefix}: no such join or context columns: {absent}")
    out_names = [f"{prefix}_{c}" for c in columns]
    marker_name = f"{prefix}_matched"
    clash = sorted((set(out_names) | ({marker_name} if marker else set())) & set(left.columns))
    if clash:
        raise ContractError(f"{prefix}: the facts already have columns {clash}")

    tmp = {lk: f"__{prefix}_key{i}" for i, lk in enumerate(mapping)}
    ctx = right.select(*[_c(rk).alias(tmp[lk]) for lk, rk in mapping.items()],
                       *[_c(c).alias(o) for c, o in zip(columns, out_names)],
                       *([F.lit(True).alias(marker_name)] if marker else []))
    cond = reduce(lambda a, b: a & b, [_c(lk) == F.col(tmp[lk]) for lk in mapping])
    use_broadcast = broadcast is not False and (
        size_ok if size_ok is not None else broadcast_fits(ctx, max_broadcast_rows, max_broadcast_bytes))
    if strategies is not None:
        strategies[prefix] = "broadcast" if use_broadcast else "shuffle"

    extra = [F.coalesce(_c(marker_name), F.lit(False)).alias(marker_name)] if marker else []
    shown = [*[_c(c) for c in left.columns], *[_c(o) for o in out_names], *extra]
    if use_broadcast:
        return left.join(F.broadcast(ctx), cond, "left").select(*shown)
    complete = reduce(lambda a, b: a & b, [_c(lk).isNotNull() for lk in mapping])
    known = reduce(lambda a, b: a & b, [F.col(t).isNotNull() for t in tmp.values()])
    hashes = _key_hashes(left, ctx, tmp)
    flag, rows, heavy, needs = f"__{prefix}_may_match", ctx.filter(known), [], []
    mark = lambda df: df
    if hashes is not None:
        of_left, of_right = hashes
        if heavy_share:
            heavy = heavy_hashes(left.filter(complete), of_left, heavy_share)
            needs += [~of_left.isin(heavy)] if heavy else []
        if member_filter:
            words = bitmap_words(rows.select(of_right.alias(flag)), flag)
            mark = lambda df: with_membership(df, of_left, words, flag)
            needs.append(_c(flag))
    own_heavy = rows.filter(of_right.isin(heavy)) if heavy else None
    if heavy and not broadcast_fits(own_heavy, max_broadcast_rows, max_broadcast_bytes):  # many rows share a heavy context key
        return join_context(left, right, keys, columns, prefix, False, marker=marker, heavy_share=None, member_filter=member_filter)
    needs_shuffle = F.coalesce(reduce(lambda a, b: a & b, needs), F.lit(False)) if needs else F.lit(True)
    staying = mark(left).filter(~complete | ~needs_shuffle) if needs else left.filter(~complete)
    moving = mark(left.filter(complete)).filter(needs_shuffle) if needs else left.filter(complete)
    staying = staying.select(*[_c(c) for c in left.columns])
    if heavy:
        staying = staying.join(F.broadcast(own_heavy), cond, "left").select(*shown)
        rows = rows.filter(~of_right.isin(heavy))
    else:
        types = {f.name: f.dataType for f in ctx.schema.fields}
        staying = staying.select(*[_c(c) for c in left.columns], *[F.lit(None).cast(types[o]).alias(o) for o in out_names],
                                 *([F.lit(False).alias(marker_name)] if marker else []))
    return moving.join(rows.hint("merge"), cond, "left").select(*shown).unionByName(staying)


def _key_hashes(left: DataFrame, ctx: DataFrame, tmp: dict[str, str]):
    """Hashes of both sides' keys that are equal where the keys are; None where their
    types differ in a way that leaves this open (the join itself converts them)."""
    mine, theirs = ({f.name: f.dataType for f in d.schema.fields} for d in (left, ctx))
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    pairs: list[tuple] = []
    for lk, name in tmp.items():
        kinds = mine[lk], theirs[name]
        if all(isinstance(k, integral) for k in kinds):
            pairs.append((_c(lk).cast("long"), F.col(name).cast("long")))
        elif kinds[0] == kinds[1] and kinds[0].simpleString() not in ("variant",) and not isinstance(kinds[0], T.MapType):
            pairs.append((_comparable(_c(lk), kinds[0]), _comparable(F.col(name), kinds[1])))
        else:
            return None
    return F.xxhash64(*[a for a, _ in pairs]), F.xxhash64(*[b for _, b in pairs])


def heavy_hashes(df: DataFrame, hashed, share: float = HEAVY_SHARE, items: int = SKETCH_ITEMS) -> list[int]:
    """The hashes that hold ``share`` of the rows or more, by one aggregate of bounded size.

    The sketch never counts a frequent hash too low, so all of them are found; one just
    below the share may be among them.
    """
    most = max(1, int(1 / share))
    got = df.select(hashed.alias("h")).agg(F.expr(f"approx_top_k(h, {most}, {max(items, 4 * most)})").alias("top"),
                                           F.count(F.lit(1)).alias("n")).first()
    return sorted(t["item"] for t in got["top"] or [] if t["item"] is not None and t["count"] >= share * got["n"])


@dataclass(frozen=True)
class JoinSpec:
    dataset: str
    keys: dict
    columns: tuple
    prefix: str
    match_column: str | None = None
    output_columns: tuple | None = None
    broadcast: bool | None = True

    @property
    def outputs(self) -> list[str]:
        cols = self.output_columns if self.output_columns is not None else self.columns
        return [f"{self.prefix}_{c}" for c in cols]

    @classmethod
    def from_dict(cls, d: dict) -> "JoinSpec":
        return cls(dataset=d["dataset"], keys=dict(d["keys"]), columns=tuple(d["columns"]),
                   prefix=d["prefix"], match_column=d.get("match_column"),
                   output_columns=tuple(d["output_columns"]) if "output_columns" in d else None,
                   broadcast=d.get("broadcast", True))


def context_profiles(items) -> list[tuple[int, int, int]]:
    """For each ``(frame, keys)``: (rows, largest number of rows sharing one
    non-null key, bytes of all values).

    Each frame is counted per key (a partial, map-side aggregation, so a hot key
    is collapsed before its shuffle); the per-key counts of all frames form one
    union that is reduced by an ``Observation`` on a ``noop`` write.  So all
    profiles are one job: the keyed aggregations run side by side, and no
    second shuffle gathers their results.
    """
    items = list(items)
    if not items:
        return []
    parts = []
    for i, (df, keys) in enumerate(items):
        keys = list(keys)
        present = reduce(lambda a, b: a & b, [_c(k).isNotNull() for k in keys])
        parts.append(df.withColumn("__bytes", value_bytes(df.schema)).groupBy(*[_c(k) for k in keys])
                     .agg(F.count(F.lit(1)).alias("__n"), F.max(present).alias("__present"), F.sum("__bytes").alias("__bytes"))
                     .select(F.lit(i).alias("__item"), "__n", "__present", "__bytes"))
    metrics = []
    for i in range(len(items)):
        mine = F.col("__item") == i
        metrics += [F.coalesce(F.sum(F.when(mine, F.col("__n"))), F.lit(0)).alias(f"rows{i}"),
                    F.coalesce(F.max(F.when(mine & F.col("__present"), F.col("__n"))), F.lit(0))
                    .alias(f"max{i}"),
                    F.coalesce(F.sum(F.when(mine, F.col("__bytes"))), F.lit(0)).alias(f"bytes{i}")]
    obs = Observation()
    (reduce(DataFrame.unionByName, parts).observe(obs, *metrics)
     .write.format("noop").mode("overwrite").save())
    got = obs.get
    return [(int(got[f"rows{i}"]), int(got[f"max{i}"]), int(got[f"bytes{i}"])) for i in range(len(items))]


def enrich(facts: DataFrame, contexts: dict[str, DataFrame], joins, *, check_keys: bool = True,
           max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
           max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, **join_options) -> DataFrame:
    """Apply ``joins`` in order (a later join may key on an earlier join's
    prefixed output), then keep the fact columns plus each join's outputs.

    Each distinct (context, keys) pair is profiled once - all of them in one
    job (``context_profiles``) - which both proves its non-null keys unique (so
    the fact row count cannot change; ``check_keys``) and measures it for the
    broadcast decision - also when the same context serves several roles.  A
    context key that repeats is refused even if no fact uses it.
    """
    joins = [j if isinstance(j, JoinSpec) else JoinSpec.from_dict(j) for j in joins]
    for j in joins:
        if j.dataset not in contexts:
            raise ContractError(f"No context table named {j.dataset!r}")
    pairs = list(dict.fromkeys((j.dataset, tuple(j.keys.values())) for j in joins))
    used = {ds: sorted({c for j in joins if j.dataset == ds for c in (*j.keys.values(), *j.columns)}) for ds, _ in pairs}
    profiles = context_profiles([(contexts[ds].select(*[_c(c) for c in used[ds]]), ckeys) for ds, ckeys in pairs])
    fits: dict[tuple, bool] = {}
    for (ds, ckeys), (rows, per_key, size) in zip(pairs, profiles):
        if check_keys and per_key > 1:
            assert_unique_context_key(contexts[ds], list(ckeys), ds)  # raises with examples
        fits[(ds, ckeys)] = rows <= max_broadcast_rows and size <= max_broadcast_bytes
    out = facts
    for j in joins:
        out = join_context(out, contexts[j.dataset], j.keys, list(j.columns), j.prefix, j.broadcast,
                           size_ok=fits[(j.dataset, tuple(j.keys.values()))], **join_options)
    return out.select(*[_c(c) for c in facts.columns], *[_c(o) for j in joins for o in j.outputs])


def match_rates(df: DataFrame, match_columns: dict[str, str]) -> DataFrame:
    """One row: ``rows`` and, per label, the non-null count of its match column."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count(_c(c)).alias(f"{label}_matches") for label, c in match_columns.items()])


def restrict_to(df: DataFrame, context: DataFrame, keys, *,
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Left semi join: keep rows whose key occurs in ``context`` (its distinct keys
    are broadcast when they pass the size check).  Rows with a null key are dropped."""
    mapping = _key_map(keys)
    tmp = {lk: f"__semi_key{i}" for i, lk in enumerate(mapping)}
    # written down, so that measuring and joining do not each make the distinct keys
    keyed = stage(context.select(*[_c(rk).alias(tmp[lk]) for lk, rk in mapping.items()]).distinct(), "semi-keys")
    if broadcast_fits(keyed, max_broadcast_rows, max_broadcast_bytes):
        keyed = F.broadcast(keyed)
    cond = reduce(lambda a, b: a & b, [_c(lk) == F.col(tmp[lk]) for lk in mapping])
    return df.join(keyed, cond, "left_semi")


def hourly_summary(df: DataFrame, group_columns, ts: str, tz: str, measure: str, labels=(),
                   hour_column: str = "hour", measure_out: str = "measurement") -> DataFrame:
    """Mean of ``measure`` per group and local hour of the UTC time ``ts``.

    Rows without a time are dropped first.  Label columns take the group's
    minimum, a deterministic pick that equals the value whenever it is constant.
    """
    rel = (df.filter(_c(ts).isNotNull())
           .withColumn(hour_column, local_hour_bucket(_c(ts), tz)))
    return rel.groupBy(*[_c(g) for g in group_columns], _c(hour_column)).agg(
        F.avg(_c(measure)).alias(measure_out), *[F.min(_c(lbl)).alias(lbl) for lbl in labels])
