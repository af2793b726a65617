"""What the tests of the training-data operators share."""

import duckdb

SMALL = "/root/testdata/sf0.001"


def oracle_rows(sql: str, folder: str, *tables: str):
    c = duckdb.connect()
    for t in tables:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c.sql(sql).df()


def as_text(df):
    """Rows as sorted tuples of text, for comparing two engines' results."""
    out = []
    df = df.sort_index(axis=1)
    for row in df.astype(object).where(df.notna(), None).itertuples(index=False):
        out.append(tuple("" if v is None or v != v else repr(float(v)) if isinstance(v, (int, float))
                         and not isinstance(v, bool) else str(v) for v in row))
    return sorted(out)
