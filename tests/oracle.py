import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def same(df, sql: str, folder: str) -> None:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    cols = sorted(df.columns)
    got = sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))
    want = sorted(map(str, con.execute(f"select {', '.join(cols)} from ({sql})").fetchall()))
    assert got == want
