"""dailywire: news, readings and index analytics as Spark DataFrame jobs.

Every operator is either a ``Column -> Column`` function (``dailywire.functions``)
or a ``DataFrame -> DataFrame`` function (``dailywire.operators``) so that plans
chain with ``df.transform(op)`` and Catalyst sees one declarative plan.
"""

from dailywire.session import get_spark, ensure_checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
