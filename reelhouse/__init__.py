"""reelhouse: a ratings lakehouse (raw -> silver -> gold) written as Spark DataFrame plans.

Every public builder is ``DataFrame(s) -> DataFrame``.  Builders are lazy but for
``plans.gold_recommendations``, which checkpoints three intermediate tables while it is
built (in ``spark.checkpoint.dir``).  Tables are written only in
``reelhouse.operators.loads`` and ``reelhouse.plans.build``.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
