"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(v)
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(_cell(v[k]) for k in sorted(v)) + "}"
    return str(v)


def rows_of(arrow) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(arrow.column_names)
    cols = [arrow.column(n).to_pylist() for n in names]
    types = [str(arrow.schema.field(n).type) for n in names]
    return names, types, sorted(tuple(_cell(v) for v in r) for r in zip(*cols))


def differences(spark, con, name: str, sf_dir: str) -> tuple[list[str], int]:
    """What differs between the query and its twin: an empty list if nothing."""
    from tapeloom.plans.registry import spark_query, twin_sql

    names, types, rows = rows_of(spark_query(name)(spark, sf_dir).toArrow())
    sql = twin_sql(name)
    if sql is None:
        return [], len(rows)
    other, otypes, orows = rows_of(con.sql(sql).to_arrow_table())
    if names != other:
        return [f"columns {names} != {other}"], len(rows)
    out = []
    norm = lambda t: t.replace("large_", "").split("[")[0]
    bad = [(n, a, b) for n, a, b in zip(names, types, otypes) if norm(a) != norm(b)]
    if bad:
        out.append(f"types {bad}")
    if rows != orows:
        mine, theirs = set(rows) - set(orows), set(orows) - set(rows)
        out.append(
            f"rows {len(rows)} vs {len(orows)}, only spark {len(mine)}, only sql {len(theirs)}:\n"
            f"  {names}\n  spark {sorted(mine)[:3]}\n  sql   {sorted(theirs)[:3]}"
        )
    return out, len(rows)


def main(argv: list[str]) -> int:
    import tapeloom.plans.catalog  # noqa: F401
    from tapeloom.plans.registry import REGISTRY
    from tapeloom.session import build_session

    sf_dir = argv[0]
    names = [n for n in REGISTRY if not argv[1:] or any(n.startswith(p) for p in argv[1:])]
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        t = time.time()
        try:
            diff, n = differences(spark, con, name, sf_dir)
        except Exception as e:  # report and go on to the next query
            diff, n = [f"{type(e).__name__}: {str(e)[:400]}"], -1
        mark = "same" if not diff else "DIFF"
        if REGISTRY[name].sql is None and not diff:
            mark = "rows"
        print(f"{mark} {name} rows={n} {time.time() - t:.1f}s", *diff, flush=True)
        failed += bool(diff)
    print(f"{len(names)} queries, {failed} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
