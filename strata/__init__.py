"""strata: a Spark-native medallion engine.

Raw text lands in *bronze*, rules split it into a typed, deduplicated
*silver* table and a *quarantine* table that records why a row was
rejected, and *gold* holds monthly metrics.  Column roles (date, id,
dimension, measure, currency, text) drive typing, validation and
deduplication.  Everything is expressed with DataFrame/SQL built-ins so
Catalyst and adaptive query execution plan the work.
"""

__version__ = "0.1.0"
