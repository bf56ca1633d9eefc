import datetime as dt

SALES_SCHEMA = ("date string, category string, revenue string, cost string, units_sold string, "
                "ingested_at timestamp, source_file string, _row_id bigint")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def sales_bronze(spark, rows, source_file="batch.csv"):
    """rows: (date, category, revenue, cost, units_sold, ingested_at text)."""
    data = [(d, c, r, co, u, ts(t), source_file, i) for i, (d, c, r, co, u, t) in enumerate(rows)]
    return spark.createDataFrame(data, SALES_SCHEMA)


def text_bronze(spark, columns, rows, ingested="2026-01-01 00:00:00", source_file="data.csv"):
    schema = ", ".join(f"`{c}` string" for c in columns) + ", ingested_at timestamp, source_file string, _row_id bigint"
    data = [tuple(r) + (ts(ingested), source_file, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def reasons(q):
    return sorted(r["rejection_reason"] for r in q.select("rejection_reason").collect())
