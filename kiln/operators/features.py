"""Fit-on-train / apply-everywhere feature stages.

Every stage is a Spark ML ``Estimator`` whose fitted ``Model`` keeps its state
as one JSON string param, so it saves and loads with ``Pipeline`` (K5) and
composes with other stages (U2).  Fits are single aggregates over the train
data; applying a model is a plain projection (lookup tables are expressions or
broadcast joins of small tables).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions import scalar as X
from kiln.operators import aggregates as AG
from kiln.operators import quantiles as Q
from kiln.operators import schema as P
from kiln.session import scratch_path


# ------------------------------------------------------------------ U1 / U2 base
class StateModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted step: ``state`` (JSON) + ``config`` (JSON) params."""

    state = Param(Params._dummy(), "state", "fitted state as JSON", TypeConverters.toString)
    config = Param(Params._dummy(), "config", "step settings as JSON", TypeConverters.toString)

    def __init__(self, state: dict | None = None, config: dict | None = None):
        super().__init__()
        self._setDefault(state="{}", config="{}")
        if state is not None:
            self._set(state=json.dumps(state, sort_keys=True, default=float))
        if config is not None:
            self._set(config=json.dumps(config, sort_keys=True))

    @property
    def st(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    @property
    def cfg(self) -> dict:
        return json.loads(self.getOrDefault(self.config))

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """A table of the state: what a fit learnt that may grow with the data."""
        return spark.read.parquet(self.st["tables"][name])

    def write(self) -> _StateWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> _StateReader:
        return _StateReader(cls)


class _StateWriter(DefaultParamsWriter):
    """Saves the tables of the state with the model."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        spark = SparkSession.active()
        for i, (_, at) in enumerate(sorted(self.instance.st.get("tables", {}).items())):
            spark.read.parquet(at).write.parquet(f"{path}/tables/{i}")


class _StateReader(DefaultParamsReader):
    """Loads a model whose tables are those saved with it."""

    def load(self, path: str) -> StateModel:
        model = super().load(path)
        st = model.st
        if st.get("tables"):
            st["tables"] = {name: f"{path}/tables/{i}" for i, name in enumerate(sorted(st["tables"]))}
            model._set(state=json.dumps(st, sort_keys=True, default=float))
        return model


class StepEstimator(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Base for user-defined fit/transform steps (U1): implement ``fit_state``."""

    config = Param(Params._dummy(), "config", "step settings as JSON", TypeConverters.toString)
    model_class: type[StateModel] = StateModel

    def __init__(self, **cfg):
        super().__init__()
        self._setDefault(config="{}")
        self._set(config=json.dumps(cfg, sort_keys=True))

    @property
    def cfg(self) -> dict:
        return json.loads(self.getOrDefault(self.config))

    def fit_state(self, df: DataFrame) -> dict:
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> StateModel:
        return self.model_class(self.fit_state(df), self.cfg)


def chain(*stages) -> Pipeline:
    """Compose steps in order (``a | b`` in the reference)."""
    return Pipeline(stages=list(stages))


def fitted_states(model: PipelineModel) -> list[tuple[str, str, str]]:
    """(step name, state, settings) of every fitted step, in order."""
    return [(type(s).__name__, s.getOrDefault(s.state), s.getOrDefault(s.config)) for s in model.stages]


def restored(stages: Sequence[StepEstimator], states: Sequence[tuple[str, str, str]]) -> PipelineModel:
    """K5: the fitted chain of ``stages`` from saved states, matched by position and step name."""
    if len(stages) != len(states):
        raise ValueError(f"{len(states)} states for {len(stages)} steps")
    out = []
    for i, (stage, (name, state, config)) in enumerate(zip(stages, states, strict=True)):
        if stage.model_class.__name__ != name:
            raise ValueError(f"step {i} is a {stage.model_class.__name__}, its state that of a {name}")
        out.append(stage.model_class(json.loads(state), json.loads(config)))
    return PipelineModel(out)


class FunctionStep(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless scalar function over columns, given as a SQL expression with
    ``{c}`` for the column name (e.g. ``log1p({c})``)."""

    expr = Param(Params._dummy(), "expr", "SQL template", TypeConverters.toString)
    cols = Param(Params._dummy(), "cols", "columns", TypeConverters.toListString)

    def __init__(self, expr: str = "{c}", cols: Sequence[str] = ()):
        super().__init__()
        self._set(expr=expr, cols=list(cols))

    def _transform(self, df: DataFrame) -> DataFrame:
        t = self.getOrDefault(self.expr)
        return df.withColumns({c: F.expr(t.format(c=f"`{c}`")) for c in self.getOrDefault(self.cols)})


# ------------------------------------------------------------------ helpers
def _code_expr(col: Column, categories: Sequence) -> Column:
    """Index of the value in ``categories`` (sorted list); null or unseen -> -1."""
    if not categories:
        return F.lit(-1)
    arr = F.array(*[F.lit(v) for v in categories])
    pos = F.array_position(arr, col.cast(T.StringType()) if isinstance(categories[0], str) else col)
    return (F.coalesce(pos, F.lit(0)) - 1).cast("int")


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


# ------------------------------------------------------------------ F1 / F2 / F3
class ImputerModel(StateModel):
    def _transform(self, df):
        fills = self.st["fills"]
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items() if c in df.columns})


class Imputer(StepEstimator):
    """F1 constant / F2 mean or most frequent / F3 median with fallback.

    ``strategy``: constant | mean | most_frequent | median.  Median falls back to
    ``fallback`` when the train column is all null."""
    model_class = ImputerModel

    def __init__(self, cols: Sequence[str] = (), strategy: str = "mean", value=0, fallback=None):
        super().__init__(cols=list(cols), strategy=strategy, value=value, fallback=fallback)

    def fit_state(self, df):
        cfg = self.cfg
        cols, how = cfg["cols"], cfg["strategy"]
        if how == "constant":
            return {"fills": {c: cfg["value"] for c in cols}}
        if how == "median":
            q = Q.multi_quantiles(df, {c: [0.5] for c in cols})
            return {"fills": {c: (q[c][0] if q[c][0] is not None else cfg["fallback"]) for c in cols}}
        if how == "mean":
            row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
            return {"fills": {c: row[c] for c in cols}}
        if how == "most_frequent":
            return {"fills": AG.modes(df, cols)}
        raise ValueError(how)


# ------------------------------------------------------------------ F8 / F9 / F7
INLINE = 1_000      # categories kept inside a model; longer lists become a table that is joined


def fit_categories(df: DataFrame, cols: Sequence[str], null_text: str | None = None) -> dict:
    """Sorted distinct values (as text) per column: ``categories`` inside the
    state, ``tables`` (value, code) for columns with more than ``INLINE``."""
    from kiln.operators import series as S
    cols = list(cols)
    if not cols:
        return {"categories": {}, "tables": {}}
    text = {c: F.col(f"`{c}`").cast("string") for c in cols}
    if null_text is not None:
        text = {c: F.coalesce(v, F.lit(null_text)) for c, v in text.items()}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("k"), v.alias("v")) for c, v in text.items()])).alias("x"))
    values = long.select("x.*").filter(F.col("v").isNotNull()).distinct()
    sizes = {r["k"]: r["n"] for r in values.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}   # one row per column
    short = [c for c in cols if sizes.get(c, 0) <= INLINE]
    cats: dict[str, list] = {c: [] for c in short}
    for r in values.filter(F.col("k").isin(short)).collect():       # at most INLINE rows per column
        cats[r["k"]].append(r["v"])
    tables = {}
    for c in cols:
        if c not in cats:
            own = S.sequence(values.filter(F.col("k") == c), ["k"], ["v"])
            tables[c] = scratch_path(df.sparkSession, f"categories-{uuid.uuid4().hex}")
            own.select(F.col("v").alias("value"), (F.col(S.SEQ) - 1).cast("int").alias("code")).write.parquet(tables[c])
    return {"categories": {c: sorted(v) for c, v in cats.items()}, "tables": tables}


def coded(df: DataFrame, model: StateModel, col: str, value: Column, out: str) -> DataFrame:
    """``out``: the code of ``value`` among the fitted categories of ``col``; null or unseen -> -1."""
    if col not in model.st.get("tables", {}):
        return df.withColumn(out, _code_expr(value, model.st["categories"].get(col, [])))
    codes = model.table(df.sparkSession, col).select(F.col("value").alias("__value"), F.col("code").alias("__code"))
    j = df.withColumn("__text", value.cast("string")).join(codes, F.col("__text") == F.col("__value"), "left")
    return j.withColumn(out, F.coalesce("__code", F.lit(-1))).drop("__text", "__value", "__code")


class CodesModel(StateModel):
    def _transform(self, df):
        st = self.st
        for c in [*st["categories"], *st.get("tables", {})]:
            if c not in df.columns:
                continue
            source, out = F.col(f"`{c}`"), self.cfg.get("prefix", "") + c
            if self.cfg.get("on_unseen") != "error":
                df = coded(df, self, c, source, out)
                continue
            df = coded(df.withColumn("__seen", source.cast("string")), self, c, source, out)
            failed = F.raise_error(F.concat(F.lit(f"unseen category in {c}: "), F.coalesce("__seen", F.lit("null"))))
            df = df.withColumn(out, F.when(F.col(f"`{out}`") >= 0, F.col(f"`{out}`")).otherwise(failed)).drop("__seen")
        return df


class CategoryCodes(StepEstimator):
    """F8: sorted distinct non-null values; null or unseen -> -1.
    F9: ``on_unseen='error'`` (ordinal encoder).  One job: unpivot + distinct."""
    model_class = CodesModel

    def __init__(self, cols: Sequence[str] = (), on_unseen: str = "minus_one", prefix: str = ""):
        super().__init__(cols=list(cols), on_unseen=on_unseen, prefix=prefix)

    def fit_state(self, df):
        return fit_categories(df, self.cfg["cols"])


class OneHotModel(StateModel):
    def _transform(self, df):
        out = {}
        for c, values in self.st["categories"].items():
            for v in values:
                out[f"{c}_{v}"] = (F.col(c).cast("string") == F.lit(v)).cast("double")
                out[f"{c}_{v}"] = F.coalesce(out[f"{c}_{v}"], F.lit(0.0))
        d = df.withColumns(out)
        return d.drop(*self.st["categories"].keys()) if self.cfg.get("drop", True) else d


class OneHot(StepEstimator):
    """one column per train category; unknown -> all zeros."""
    model_class = OneHotModel

    def __init__(self, cols: Sequence[str] = (), drop: bool = True):
        super().__init__(cols=list(cols), drop=drop)

    def fit_state(self, df):
        state = fit_categories(df, self.cfg["cols"])
        if state["tables"]:     # every category is a column of the result
            raise ValueError(f"one-hot encoding of over {INLINE} categories: {sorted(state['tables'])}; use CategoryCodes")
        return state


# ------------------------------------------------------------------ F10
class LabelCodes(StepEstimator):
    """encode labels only when they are not already 0..n-1 (invertible)."""
    model_class = CodesModel

    def __init__(self, col: str = "label"):
        super().__init__(cols=[col], prefix="")

    def fit_state(self, df):
        c = self.cfg["cols"][0]
        r = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"), F.countDistinct(c).alias("n")).first()
        numeric = _is_numeric(df, c)
        if numeric and r["lo"] == 0 and r["hi"] == r["n"] - 1:
            return {"categories": {}, "identity": True}
        if r["n"] > INLINE:
            raise ValueError(f"{r['n']} labels in {c}: a target of so many values is not a class")
        vals = sorted(x[0] for x in df.select(F.col(c).cast("string")).distinct().collect() if x[0] is not None)
        if numeric:
            vals = sorted(vals, key=float)
        return {"categories": {c: vals}, "identity": False}


def decode_labels(df: DataFrame, model: CodesModel, col: str) -> DataFrame:
    """Codes back to labels: the inverse of a fitted ``LabelCodes`` (unknown codes become null)."""
    values = model.st["categories"].get(col)
    if values is None:                      # the labels were codes already
        return df
    labels = F.array(*[F.lit(v) for v in values])
    return df.withColumn(col, F.try_element_at(labels, F.when(F.col(col) >= 0, F.col(col) + 1).cast("int")))


# ------------------------------------------------------------------ F11 / F12 / F13
class ScaleModel(StateModel):
    def _transform(self, df):
        st, kind = self.st, self.cfg["kind"]
        out = {}
        for c, (a, b) in st["params"].items():
            x = F.col(c).cast("double")
            if self.cfg.get("log1p"):
                x = F.log1p(x)
            if kind == "standard":
                out[c] = (x - F.lit(a)) / F.lit(b if b else 1.0)
            else:
                rng = b - a
                out[c] = (x - F.lit(a)) / F.lit(rng) if rng else F.lit(0.0)
        return df.withColumns(out)


class Scaler(StepEstimator):
    """F11 standard (population std; zero std -> divide by 1), F12 min-max
    (constant column -> 0), F13 ``log1p`` first."""
    model_class = ScaleModel

    def __init__(self, cols: Sequence[str] = (), kind: str = "standard", log1p: bool = False):
        super().__init__(cols=list(cols), kind=kind, log1p=log1p)

    def fit_state(self, df):
        cols, kind = self.cfg["cols"], self.cfg["kind"]
        xs = {c: (F.log1p(F.col(c).cast("double")) if self.cfg["log1p"] else F.col(c).cast("double")) for c in cols}
        if kind == "standard":
            row = df.agg(*[F.avg(x).alias(f"a_{c}") for c, x in xs.items()],
                         *[F.stddev_pop(x).alias(f"b_{c}") for c, x in xs.items()]).first()
        else:
            row = df.agg(*[F.min(x).alias(f"a_{c}") for c, x in xs.items()],
                         *[F.max(x).alias(f"b_{c}") for c, x in xs.items()]).first()
        return {"params": {c: [row[f"a_{c}"], row[f"b_{c}"]] for c in cols}}


# ------------------------------------------------------------------ P16-P18 as one step
class SpendModel(StateModel):
    def _transform(self, df):
        cols, st = self.cfg["cols"], self.st
        d = P.spend_features(df, cols, st["categories"], st["all_zero"])
        flags = P.threshold_flags(d, cols, st["thresholds"], drop_originals=False)
        return flags


class SpendFeatures(StepEstimator):
    """Total spend (P16), arg-max category codes (P17), used / above-quartile
    flags against train quartiles (P18).  Service columns: lenient numbers, nulls 0."""
    model_class = SpendModel

    def __init__(self, cols: Sequence[str] = ()):
        super().__init__(cols=list(cols))

    def fit_state(self, df):
        cols = [c for c in self.cfg["cols"] if c in df.columns]
        d = df.select(*[F.coalesce(X.lenient_double(c), F.lit(0.0)).alias(c) for c in cols])
        nonzero = F.lit(False)
        for c in cols:
            nonzero = nonzero | (F.col(c) != 0)
        row = d.agg(F.collect_set(X.row_argmax(cols)).alias("cats"),
                    F.max(nonzero.cast("int")).alias("any_nonzero")).first()
        q = Q.multi_quantiles(d, {c: [0.25, 0.5, 0.75] for c in cols})
        thresholds = {c: dict(zip(("q25", "q50", "q75"), q[c])) for c in cols}
        all_zero = not row["any_nonzero"]
        return {"categories": None if all_zero else sorted(row["cats"]), "all_zero": all_zero,
                "thresholds": thresholds}


# ------------------------------------------------------------------ F4
# Id / time columns the generic transformer drops, null markers.
RAW_DROP = ("TransactionID", "TransactionDT")
FIT_NULL = "NaN_placeholder_fit"
APPLY_NULL = "NaN_placeholder_transform"
NEW_NULL = "missing_new_col"


def own_codes(df: DataFrame, col: str, null_text: str) -> DataFrame:
    """Codes of a column by its own sorted distinct values (dense rank - 1),
    from a distinct-value table numbered on the series machinery."""
    from kiln.operators import series as S
    v = F.coalesce(F.col(col).cast("string"), F.lit(null_text))
    vals = df.select(v.alias("_v")).distinct().withColumn("_k", F.lit(0))
    seq = S.sequence(vals, ["_k"], ["_v"]).select("_v", (F.col(S.SEQ) - 1).cast("int").alias("_code"))
    from kiln.operators import joins as J
    out = J.lookup_join(df.withColumn("_v", v), seq, "_v", "left")
    return out.withColumn(col, F.col("_code")).drop("_v", "_code")


class RawModel(StateModel):
    def _transform(self, df):
        st = self.st
        d = df.drop(*[c for c in RAW_DROP if c in df.columns])
        out = {}
        for c in d.columns:
            if c in st["medians"]:
                out[c] = F.coalesce(X.lenient_double(c), F.lit(st["medians"][c]))
        d = d.withColumns(out)
        for c in [c for c in d.columns if c in st["modes"] and c not in st["medians"]]:
            d = coded(d, self, c, F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(str(st["modes"][c]))), c)
        for c in d.columns:
            if c in st["medians"] or c in st["modes"]:
                continue
            if _is_numeric(d, c):
                d = d.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
            else:
                d = own_codes(d, c, NEW_NULL)
        return d


class RawTransformer(StepEstimator):
    """fit medians (numeric), modes and sorted category lists (others, nulls
    as a placeholder category) in one pass each; apply: lenient numbers with the
    median, categories filled with the mode then coded (unseen -> -1); columns
    unseen at fit: numbers filled with 0, text coded by its own categories."""
    model_class = RawModel

    def fit_state(self, df):
        d = df.drop(*[c for c in RAW_DROP if c in df.columns])
        numeric = [c for c in d.columns if _is_numeric(d, c)]
        other = [c for c in d.columns if c not in numeric]
        med = Q.multi_quantiles(d, {c: [0.5] for c in numeric}) if numeric else {}
        modes = {c: "missing" if v is None else v for c, v in AG.modes(d, other).items()}
        return {"medians": {c: med[c][0] for c in numeric}, "modes": modes, **fit_categories(d, other, FIT_NULL),
                "columns": list(df.columns)}


# ------------------------------------------------------------------ F5
class PassengerModel(StateModel):
    def _transform(self, df):
        st, cfg = self.st, self.cfg
        d = df.drop(*[c for c in (cfg["id_col"],) if c in df.columns])
        for c in cfg["bool_cols"]:
            if c in d.columns:
                d = d.withColumn(c, X.text_to_bool(c, null_as_false=True))
        for c in cfg["code_cols"]:
            if c in d.columns:
                d = coded(d, self, c, F.col(c), c)
        svc = [c for c in cfg["service_cols"] if c in d.columns]
        d = P.spend_features(d, svc, st["spend_categories"], st["all_zero"])
        age = cfg["age_col"]
        if age in d.columns:
            fill = st["age_median"]
            if fill is None:
                own = Q.column_quantiles(d, age, [0.5])[0]
                fill = own if own is not None else 30.0
            d = d.withColumn(age, F.coalesce(F.col(age).cast("double"), F.lit(fill)))
        cab = cfg["cabin_col"]
        if cab in d.columns:
            deck, num, side = X.split_code(cab)
            d = d.withColumns({"__deck": deck, "cabin_num": num, "__side": side})
            d = coded(coded(d, self, "deck", F.col("__deck"), "deck"), self, "side", F.col("__side"), "side")
            d = d.drop(cab, "__deck", "__side")
        return d.drop(*[c for c in cfg["drop_cols"] if c in d.columns])


class PassengerTransformer(StepEstimator):
    """domain raw transformer: id dropped (P2), text booleans null -> false
    (P11), category codes (F8), service totals and arg-max category (P16, P17),
    age median with fallback (F3), ``deck/num/side`` split (P12); name-like
    columns dropped after the word features used them."""
    model_class = PassengerModel

    def __init__(self, id_col="PassengerId", bool_cols=("CryoSleep", "VIP"), code_cols=("HomePlanet", "Destination"),
                 service_cols=("RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck"), age_col="Age",
                 cabin_col="Cabin", drop_cols=("Name", "Ticket")):
        super().__init__(id_col=id_col, bool_cols=list(bool_cols), code_cols=list(code_cols),
                         service_cols=list(service_cols), age_col=age_col, cabin_col=cabin_col,
                         drop_cols=list(drop_cols))

    def fit_state(self, df):
        cfg = self.cfg
        fitted = fit_categories(df, [c for c in cfg["code_cols"] if c in df.columns])
        codes, tables = fitted["categories"], dict(fitted["tables"])
        svc = [c for c in cfg["service_cols"] if c in df.columns]
        spend = SpendFeatures(svc).fit_state(df) if svc else {"categories": None, "all_zero": True}
        age = Q.column_quantiles(df, cfg["age_col"], [0.5])[0] if cfg["age_col"] in df.columns else None
        deck = side = None
        if cfg["cabin_col"] in df.columns:
            dk, _, sd = X.split_code(cfg["cabin_col"])
            parts = df.select(dk.alias("d"), sd.alias("s"))
            found = fit_categories(parts, ["d", "s"])
            deck, side = found["categories"].get("d"), found["categories"].get("s")
            tables |= {k: found["tables"][v] for k, v in (("deck", "d"), ("side", "s")) if v in found["tables"]}
        return {"categories": {**codes, "deck": deck or [], "side": side or []}, "tables": tables, "spend_categories": spend["categories"], "all_zero": spend["all_zero"],
                "age_median": age}
