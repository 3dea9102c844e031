"""procura: procure-to-pay lineage reports as Spark DataFrame plans.

Sub-packages:

* ``functions``  column-expression helpers (typed NULLs, dotted codes,
  currency conversion, NULL-policy flags, validity intervals).
* ``operators``  reusable DataFrame operators (dated joins, strict one-row
  lookups, first/last events, latest-per-key, ordered string aggregation,
  NULL-spreading outer joins, union distinct, drill-down).
* ``sources``    table loading and the P2P-shaped tables derived from the
  driver's star-schema data.
* ``plans``      the report blocks and the three reports.
* ``llm``        optional training-data operators; nothing else imports them.
"""

from procura.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
