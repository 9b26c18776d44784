"""ml09: one boosted model over all classes (LogitBoost: Friedman, Hastie, Tibshirani 2000).

Every class has a margin, and the softmax of the margins is its probability.  A
round fits one regression tree a class, with Spark's tree learner, to the working
responses (y - p) / w weighted by w = p (1 - p), so that a leaf's mean is a Newton
step, and adds the trees to the margins.  A class's trees make up a
``GBTRegressionModel``, whose prediction is its margin: scoring is one projection,
and saving and loading are Spark's.

Beyond small tables the trees are fitted over the rows' entries, all classes at once
(``operators/forest.py``).  Below, the rows and their margins are cached from round to round and written every
``CUT`` rounds, which bounds what a lost executor makes Spark compute again.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.operators.forest import fit_softmax
from shipcast.operators.quantiles import drop_stable, stable

#: Rounds between written margins.
CUT = 10
#: Least weight of a row: bounds a working response by 1 / LEAST.  Weight times response
#: stays y - p, so sure but wrong rows pull in full, and the steps of sure rows are shorter.
LEAST = 0.05


def softmax(margins: list[Column]) -> list[Column]:
    top = F.greatest(*margins)
    powers = [F.exp(m - top) for m in margins]
    total = sum(powers[1:], powers[0])
    return [p / total for p in powers]


class SoftmaxBoosting(Estimator):
    """Trees take the options of ``RandomForestRegressor`` (``maxDepth``, ``minInfoGain``,
    ``minInstancesPerNode``, ``featureSubsetStrategy``, ``subsamplingRate``).

    Rows have ``label`` (0, 1, ...) and ``features``.  There are as many classes as
    the largest label asks for, and at least two; a class without rows gets a
    vanishing probability.  Rows without label are left out; without any row the fit
    is refused."""

    def __init__(self, maxIter: int = 100, stepSize: float = 0.1, seed: int = 42, parallelism: int = 3, **tree):
        super().__init__()
        self.rounds, self.step, self.seed, self.parallelism, self.tree = maxIter, stepSize, seed, parallelism, tree

    def _fit(self, dataset: DataFrame) -> SoftmaxBoostingModel:
        rows = dataset.where(F.col("label").isNotNull()).select(F.col("label").cast("int").alias("label"), "features")
        top = rows.agg(F.max("label")).first()[0]
        if top is None:
            raise ValueError("no labelled rows to fit")
        classes = range(max(top + 1, 2))
        rate = self.step * (len(classes) - 1) / len(classes)
        tree = RandomForestRegressor(numTrees=1, bootstrap=False, seed=self.seed, **self.tree)
        if self.rounds and (fitted := fit_softmax(rows, tree, len(classes), self.rounds, rate, LEAST, CUT)):
            return SoftmaxBoostingModel(*fitted)
        margin = [F.col(f"margin{k}") for k in classes]
        state = written = stable(rows.withColumns({f"margin{k}": F.lit(0.0) for k in classes}))
        held, trees, losses = [], [[] for _ in classes], []
        pool = ThreadPool(min(self.parallelism, len(classes)))
        try:
            for turn in range(self.rounds):
                p = softmax(margin)

                @inheritable_thread_target(rows.sparkSession)
                def tree(k: int, state=state, p=p, turn=turn):
                    weight = F.greatest(p[k] * (1 - p[k]), F.lit(LEAST))
                    response = ((F.col("label") == k).cast("double") - p[k]) / weight
                    return RandomForestRegressor(
                        numTrees=1, bootstrap=False, labelCol="response", weightCol="weight", predictionCol=f"tree{k}",
                        seed=self.seed + turn, **self.tree).fit(
                            state.select("features", weight.alias("weight"), response.alias("response")))

                after = state
                for k, model in enumerate(pool.map(tree, classes)):
                    trees[k].append(model.trees[0])
                    after = model.transform(after)
                after = after.select("label", "features", *[(margin[k] + rate * F.col(f"tree{k}")).alias(f"margin{k}")
                                                           for k in classes])
                cut = (turn + 1) % CUT == 0 or turn + 1 == self.rounds
                state = stable(after) if cut else after.persist()
                if cut:
                    losses.append(self._loss(state, margin))
                    drop_stable(written)
                    written = state
                else:
                    held.append(state)
                # The rows before the last ones are no longer read.
                while len(held) > (0 if cut else 2):
                    held.pop(0).unpersist()
        finally:
            pool.close()
            for rows in held:
                rows.unpersist()
            drop_stable(written)
        return SoftmaxBoostingModel([_ensemble(t, rate) for t in trees], losses)

    @staticmethod
    def _loss(state: DataFrame, margin: list[Column]) -> float:
        """Mean log-loss of the rows."""
        own = F.coalesce(*[F.when(F.col("label") == k, p) for k, p in enumerate(softmax(margin))])
        return float(state.agg(F.avg(-F.log(F.greatest(own, F.lit(1e-300))))).first()[0])


def _ensemble(trees: list, rate: float) -> GBTRegressionModel:
    """The sum of ``rate`` times each tree, as Spark's own boosted model."""
    sc = SparkSession.active().sparkContext
    java = sc._jvm.org.apache.spark.ml.regression
    array = JavaWrapper._new_java_array([t._java_obj for t in trees], java.DecisionTreeRegressionModel)
    weights = JavaWrapper._new_java_array([rate] * len(trees), sc._gateway.jvm.double)
    return GBTRegressionModel(java.GBTRegressionModel(trees[0].uid + "-sum", array, weights))


class _Writer(MLWriter):
    def __init__(self, model: SoftmaxBoostingModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={
            "classes": len(self.model.margins), "losses": self.model.losses})
        for k, margin in enumerate(self.model.margins):
            margin.save(f"{path}/margins/{k}")


class _Reader(MLReader):
    def load(self, path: str) -> SoftmaxBoostingModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = SoftmaxBoostingModel([GBTRegressionModel.load(f"{path}/margins/{k}") for k in range(meta["classes"])],
                                     meta["losses"])
        model._resetUid(meta["uid"])
        return model


class SoftmaxBoostingModel(Model, MLWritable, MLReadable):
    """A margin per class, and the training log-loss at every ``CUT`` rounds and the last."""

    def __init__(self, margins: list[GBTRegressionModel] | None = None, losses: list[float] | None = None):
        super().__init__()
        self.margins, self.losses = margins or [], losses or []

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Adds probability (a vector) and prediction (the likeliest class, the first of equals)."""
        names = [f"{self.uid}_{k}" for k in range(len(self.margins))]
        out = dataset
        for name, margin in zip(names, self.margins):
            out = margin.setPredictionCol(name).transform(out)
        share = f"{self.uid}_share"
        likeliest = F.array_position(share, F.array_max(share)) - 1
        return (out.withColumn(share, F.array(*softmax([F.col(n) for n in names])))
                .withColumns({"probability": array_to_vector(share), "prediction": likeliest.cast("double")})
                .drop(share, *names))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()
