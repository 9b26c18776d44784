"""pp01 as savable stages: every fitted preprocessing step is a ``Model`` with its
state tables (one row of bounds or medians, one row per group), so that one
``PipelineModel`` takes raw orders to processed ones, and with an assembler and a
learner behind it to predictions.

A step is written as its options (in the metadata) and its tables (Parquet);
reading it back needs nothing else.  Statistics come from the rows that are
fitted, which are the train rows.
"""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.functions.columns import numeric_columns
from shipcast.operators import clean as C
from shipcast.operators import encode as E
from shipcast.operators import features as FE
from shipcast.operators.quantiles import stable

KEY = "order_id"


class _StepWriter(MLWriter):
    def __init__(self, step: Step):
        super().__init__()
        self.step = step

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.step, path, self.sparkSession, extraMetadata={
            "options": self.step.options, "tables": sorted(self.step.tables)})
        for name, table in self.step.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _StepReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> Step:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        step = self.kind(meta["options"], {t: self.sparkSession.read.parquet(f"{path}/tables/{t}") for t in meta["tables"]})
        step._resetUid(meta["uid"])
        return step


class Step(Model, MLWritable, MLReadable):
    """A fitted step: JSON options and state tables."""

    def __init__(self, options: dict | None = None, tables: dict[str, DataFrame] | None = None):
        super().__init__()
        self.options, self.tables = options or {}, tables or {}

    def write(self) -> MLWriter:
        return _StepWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StepReader(cls)


class Repair(Step):
    """pj01, cl01: leakage columns go, impossible values become NULL."""

    def _transform(self, dataset):
        return C.null_negatives(C.drop_leakage(dataset, self.options["task"]))


class Winsorize(Step):
    """cl02, with the fitted bounds."""

    def _transform(self, dataset):
        return C.apply_winsor(dataset, self.tables["bounds"])


class ImputeGroups(Step):
    """cl03 to cl05, with the medians of every route, product and category."""

    def _transform(self, dataset):
        for name in self.options["specs"]:
            keys, cols = C.IMPUTE_SPECS[name]
            dataset = C.apply_group_medians(dataset, self.tables[f"{name}_groups"], self.tables[f"{name}_all"], keys, cols,
                                            all_null_group_falls_back=(name == "category"))
        return dataset


class FillGlobal(Step):
    """cl06, with the medians of the columns that have NULLs in train."""

    def _transform(self, dataset):
        need, numeric = self.options["need"], self.options["numeric"]
        rows = dataset.crossJoin(F.broadcast(self.tables["medians"])) if need else dataset
        # Doubles throughout, so that the schema does not depend on which columns hold a NULL.
        return rows.select(*[
            F.coalesce(F.col(c), F.col(f"{c}__fill")).cast("double").alias(c) if c in need
            else F.col(c).cast("double").alias(c) if c in numeric else F.col(c) for c in dataset.columns])


class Derive(Step):
    """fe01 to fe13, with the statistics of fe10 and fe11."""

    def _transform(self, dataset):
        out = FE.engineer_with(dataset, self.tables.get("state"))
        return out.select("*", *[e.alias(n) for n, e in FE.log_cost_exprs(out).items()])


class Scale(Step):
    """nm01, with means and deviations."""

    def _transform(self, dataset):
        return E.apply_scaler(dataset, self.tables["moments"])


class Text(Step):
    """The categorical columns as strings."""

    def _transform(self, dataset):
        return dataset.withColumns({c: F.col(c).cast("string") for c in self.options["columns"]})


class Drop(Step):
    """Columns that only the encoding needed."""

    def _transform(self, dataset):
        return dataset.drop(*self.options["columns"])


def fit_preprocessing(train: DataFrame, task: str = "all") -> PipelineModel:
    """pp01 fitted on ``train`` in the reference's order: drop, repair, winsorize,
    impute, derive, scale, encode.  The train rows are written once, after the
    group medians; every other step is a projection of what is there."""
    steps: list = [Repair({"task": task})]

    def after(step, rows):
        steps.append(step)
        return step.transform(rows)

    rows = steps[0].transform(train)
    rows = after(Winsorize(tables={"bounds": stable(C.fit_winsor(rows))}), rows)
    fits, tables = C.fit_impute_specs(rows), {}
    for name, (groups, all_rows) in fits.items():
        tables |= {f"{name}_groups": stable(groups), f"{name}_all": stable(all_rows)}
    rows = stable(after(ImputeGroups({"specs": [n for n in C.IMPUTE_SPECS if n in fits]}, tables), rows))
    numeric = numeric_columns(rows, exclude=(KEY,))
    need = C.columns_with_nulls(rows, numeric)
    medians = {"medians": stable(C.fit_global_medians(rows, need, suffix="__fill"))} if need else {}
    rows = after(FillGlobal({"need": need, "numeric": numeric}, medians), rows)
    state = FE.fit_feature_state(rows)
    rows = after(Derive(tables={} if state is None else {"state": stable(state)}), rows)
    rows = after(Scale(tables={"moments": stable(E.fit_scaler(rows, numeric_columns(rows, exclude=(KEY,))))}), rows)
    cols, encoders = E.fit_one_hot(rows)
    if cols:
        steps += [Text({"columns": cols}), *encoders,
                  Drop({"columns": [x for c in cols for x in (c, f"{c}__idx")]})]
    return PipelineModel(steps)


def for_task(fitted: PipelineModel, raw: DataFrame, task: str) -> tuple[PipelineModel, list[str]]:
    """``fit_preprocessing(train, task)`` from the fit for all tasks, and the columns that it makes.  A task only
    lacks columns, and every statistic is one column's own, so the fit's tables are read without those columns."""
    rows, steps = raw.limit(0), []
    for step in fitted.stages:
        if isinstance(step, Repair):
            step = Repair({"task": task})
        elif isinstance(step, Winsorize):
            step = Winsorize(tables={"bounds": _columns(step.tables["bounds"], rows, ("_p01", "_p99"))})
        elif isinstance(step, ImputeGroups):
            specs = [n for n in step.options["specs"] if any(c in rows.columns for c in C.IMPUTE_SPECS[n][1])]
            step = ImputeGroups({"specs": specs}, {t: _columns(x, rows, ("__grp", "__glob")) for t, x in step.tables.items()
                                                   if t.rsplit("_", 1)[0] in specs})
        elif isinstance(step, FillGlobal):
            need, numeric = ([c for c in step.options[o] if c in rows.columns] for o in ("need", "numeric"))
            medians = {"medians": _columns(step.tables["medians"], rows, ("__fill",))} if need else {}
            step = FillGlobal({"need": need, "numeric": numeric}, medians)
        elif isinstance(step, Scale):
            step = Scale(tables={"moments": _columns(step.tables["moments"], rows, ("__mean", "__std"))})
        elif isinstance(step, (Text, Drop)):
            if missing := [c for c in step.options["columns"] if c not in rows.columns]:
                raise ValueError(f"{task}: no column {missing} to encode")
        steps.append(step)
        rows = step.transform(rows)
    return PipelineModel(steps), rows.columns


def _columns(state: DataFrame, rows: DataFrame, ends: tuple[str, ...]) -> DataFrame:
    """A state table without the statistics, which end in ``ends``, of columns that ``rows`` has not."""
    return state.select(*[c for c in state.columns
                          if not any(c.endswith(e) and c.removesuffix(e) not in rows.columns for e in ends)])
