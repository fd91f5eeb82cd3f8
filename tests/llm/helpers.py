"""What the tests of this folder share."""

import duckdb

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["s"])[i % len(sources or ["s"])], len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def duck_rows(sql, tmp_path, **frames):
    """Rows of a DuckDB query over DataFrames, written as parquet first."""
    con = duckdb.connect()
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(str(tmp_path / name))
        con.execute(f"create view {name} as select * from '{tmp_path / name}/*.parquet'")
    r = con.execute(sql)
    columns = [c[0] for c in r.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in r.fetchall()), key=repr)


def spark_rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
