"""Runs ``Grow.java``, the JVM twin of :func:`trees.fitted` for boosted and bagged trees, in Spark tasks.

The source is compiled once a session by Janino, the compiler that Spark's own code generation uses, and its jar is
added to the session. A task reads all binned rows of a design from the checkpoint folder and grows the parts of its
group one after the other; trees and held-out predictions leave it as they are finished. Nothing is shuffled, and the
driver sees the settings alone.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.operators import trees as K

OUT = "job int, row long, p array<double>, part int, tree int, nodes binary, bytes int, seconds double"
CLASS = "geotrace.Grow"
#: Numbers of the histograms that a task keeps of open nodes.
KEPT_NUMBERS = 1 << 23


def _class(spark: SparkSession):
    """The compiled class in the driver; executors get its jar from the session."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    if getattr(sc, "_geotrace_grow", None) is None:
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook((Path(__file__).parent / "Grow.java").read_text())
        path = Path(tempfile.mkdtemp(prefix="geotrace-jar-")) / "geotrace-grow.jar"
        with zipfile.ZipFile(path, "w") as jar:
            for name, code in dict(compiler.getBytecodes()).items():
                jar.writestr(name.replace(".", "/") + ".class", bytes(code))
        sc._jsc.addJar(str(path))
        urls = sc._gateway.new_array(jvm.java.net.URL, 1)
        urls[0] = jvm.java.io.File(str(path)).toURI().toURL()
        loader = jvm.java.net.URLClassLoader(urls, jvm.java.lang.Thread.currentThread().getContextClassLoader())
        sc._geotrace_grow = loader.loadClass(CLASS)
    return sc._geotrace_grow


def grows(g: K.Grower, targets: int, p: int) -> bool:
    """Whether the JVM grows such parts; AdaBoost and splits shared by more than two targets stay in numpy."""
    return g.kind in ("bag", "boost") and targets <= 2 and 0 < p < 1 << 15 and abs(g.seed) < 1 << 53


def _numbers(part, p: int) -> list[float]:
    g = part.grower
    drawn = max(1, int(g.tree_features * p)) if g.tree_features < 1 else p
    boot = {"none": 0, "poisson": 1, "bayes": 2}[g.bootstrap]
    return [part.job, part.fold is not None, -1 if part.fold is None else part.fold, g.kind == "boost", g.trees, g.depth, g.leaves,
            g.symmetric, g.random_cuts, boot, drawn, K.subset_size(g.node_features, drawn), g.bags, part.bag, part.first, part.last, g.seed,
            g.rate, g.rows, g.min_leaf, g.min_split, g.min_weight, g.l1, g.l2, g.min_gain, len(part.targets), *part.targets]


def _spec(d, parts: list, groups: list[list[int]]) -> bytes:
    p, step = len(d.edges), K.gradient_step(d.largest)
    values = d.values.ravel() if any(x.grower.random_cuts for x in parts) else []
    cdf = K.poisson_cdf()
    head = [p, len(d.targets), d.count, K.target_step(d.largest), step, KEPT_NUMBERS, len(cdf), *cdf, len(values), *values, len(parts)]
    body = [x for part in parts for x in _numbers(part, p)]
    tail = [len(groups), *[x for g in groups for x in (len(g), *g)]]
    return np.array([*head, *body, *tail], "<f8").tobytes()


def run(d, parts: list, groups: list[list[int]]) -> DataFrame:
    """``OUT`` rows of ``parts``, whose numbers ``groups`` deals to tasks: held-out predictions (job, row, p, seconds) and, of
    jobs on all rows, the trees (job, part, tree, nodes, bytes), with what the part adds to them in ``p``."""
    spark = d.rows.sparkSession
    sc = spark.sparkContext
    rows = d.rows.select("row", "draw", "fold", "bins", *[F.col("y")[t] for t in range(len(d.targets))])
    args = sc._gateway.new_array(sc._jvm.java.lang.Object, 1)
    args[0] = _spec(d, parts, groups)
    grow = _class(spark).getConstructors()[0].newInstance(args)
    whole = rows._jdf.toJavaRDD().coalesce(1)  # a partition, and so a task, has all rows: each reads them itself
    copies = sc._gateway.new_array(sc._jvm.org.apache.spark.api.java.JavaRDD, len(groups))
    for i in range(len(groups)):
        copies[i] = whole
    grown = sc._jsc.union(copies).mapPartitionsWithIndex(grow, False)
    schema = spark._jsparkSession.parseDataType(T.StructType.fromDDL(OUT).json())
    return DataFrame(spark._jsparkSession.createDataFrame(grown, schema), spark)


def decoded(nodes: bytes, targets: int) -> K.Fixed:
    """A tree from its bytes."""
    n = len(nodes) // (7 + 8 * targets)
    feature, cut, left = np.frombuffer(nodes, "<i2", n), np.frombuffer(nodes, np.uint8, n, 2 * n), np.frombuffer(nodes, "<i4", n, 3 * n)
    value = np.frombuffer(nodes, "<f8", targets * n, 7 * n).reshape(targets, n)
    return K.Fixed(feature.astype(np.int32), cut.astype(np.int32), left, np.ascontiguousarray(value.T))
