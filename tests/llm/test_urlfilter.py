from datetime import datetime, timedelta
import random

import duckdb

from pricefold.llm import urlfilter

T0 = datetime(2024, 1, 1)


def at(hours):
    return T0 + timedelta(hours=hours)


def keys(host, path):
    labels = host.split(".")
    out = [".".join(labels[i:]) for i in range(max(1, len(labels) - 1))]
    seg = [s for s in path.split("/") if s][:urlfilter.DEPTH]
    return out + [host + "/" + "/".join(seg[:i + 1]) for i in range(len(seg))]


def brute(captures, changes):
    out = []
    for page, host, path, t in captures:
        active = []
        for k in keys(host, path):
            state, since = False, None
            for when in sorted({c[2] for c in changes if c[0] == k and c[2] <= t}):
                now = min(a for e, a, w in changes if e == k and w == when)
                if now and not state:
                    since = when
                state = now
            if state:
                active.append((-len(k), k, since))
        best = min(active, default=(0, None, None))
        out.append((page, bool(active), len(active), best[1], best[2]))
    return out


def test_random_histories_equal_brute_force(spark):
    rng = random.Random(2)
    hosts = ["a.x.org", "b.x.org", "x.org", "y.com", "www.y.com"]
    captures = [(i, rng.choice(hosts), rng.choice(["", "/", "/p", "/p/q", "/p/q/r", "/q"]), at(rng.randrange(0, 400))) for i in range(300)]
    entries = ["x.org", "a.x.org", "y.com/p", "b.x.org/p/q", "www.y.com", "y.com"]
    changes = [(rng.choice(entries), rng.random() < 0.55, at(rng.randrange(-50, 420))) for _ in range(200)]
    c = spark.createDataFrame([(i, f"https://{h}{p}?z=1", t) for i, h, p, t in captures], "page_id long, url string, fetched_at timestamp")
    d = spark.createDataFrame(changes, "entry string, added boolean, at timestamp")
    for chunk in (urlfilter.CHUNK, 1800, 3 * 86400):
        got = [(r["page_id"], r["listed"], r["n_entries"], r["entry"], r["since"]) for r in urlfilter.judge(c, d, chunk).collect()]
        assert sorted(got) == sorted(brute(captures, changes))
    spans = [tuple(r) for r in urlfilter.intervals(d, chunk=7200).collect()]
    assert sorted(spans, key=str) == sorted((tuple(r) for r in urlfilter.intervals(d).collect()), key=str)


def test_five_years_take_no_row_per_period(spark):
    changes = [("old.org", True, T0), ("on-off.org", True, T0), ("on-off.org", False, at(8000)), ("on-off.org", True, at(20_000))]
    d = spark.createDataFrame(changes, "entry string, added boolean, at timestamp")
    times = [0, 1, 7999, 8000, 19_999, 20_000, 43_800]
    asked = spark.createDataFrame([(e, at(h)) for e in ("old.org", "on-off.org", "new.org") for h in times], "entry string, at timestamp")
    spans = urlfilter.intervals(d)
    assert spans.count() == 3  # as many rows as additions
    got = {(r["entry"], r["at"]): r["since"] for r in urlfilter.as_of(asked, spans).collect()}
    want = {("old.org", at(h)): T0 for h in times} | {("on-off.org", at(h)): at(0) for h in (0, 1, 7999)} \
        | {("on-off.org", at(h)): at(20_000) for h in (20_000, 43_800)}
    assert got == want


def test_every_event_makes_an_entry(spark):
    con = duckdb.connect()
    for t in ("events", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    sql = urlfilter.OP7_SQL
    start = sql.index("WITH p AS")
    changes, total = con.execute(sql[start:sql.index("once AS")].rstrip().rstrip(",") + " SELECT (SELECT count(*) FROM changes), "
                                 "(SELECT count(*) FROM events WHERE event_type IN ('error', 'purchase'))").fetchone()
    assert changes == total > 100
    want = con.execute(f"SELECT * FROM ({sql})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in urlfilter.op7_query(spark, "/root/testdata/sf0.001").collect())


def test_deep_entries_match(spark):
    d = spark.createDataFrame([("x.org/a/b/c/d", True, at(0)), ("x.org/a/b", True, at(0))], "entry string, added boolean, at timestamp")
    urls = ["http://x.org/a/b/c/d", "http://x.org/a/b/c/d/e?z=1", "http://x.org/a/b/c", "http://x.org/a"]
    c = spark.createDataFrame([(i, u, at(1)) for i, u in enumerate(urls)], "page_id long, url string, fetched_at timestamp")
    got = {r["page_id"]: (r["n_entries"], r["entry"]) for r in urlfilter.judge(c, d).collect()}
    assert got == {0: (2, "x.org/a/b/c/d"), 1: (2, "x.org/a/b/c/d"), 2: (1, "x.org/a/b"), 3: (0, None)}


def test_cases(spark):
    changes = [("x.org", True, at(1)), ("x.org", True, at(2)), ("x.org", False, at(5)), ("x.org", True, at(5)), ("y.org", False, at(0)),
               (None, True, at(0)), (" ", True, at(0)), ("z.org", None, at(0)), ("z.org", True, None), ("localhost", True, at(0)), ("x.org", True, at(9))]
    d = spark.createDataFrame(changes, "entry string, added boolean, at timestamp").selectExpr("*", "'clash' AS url")
    captures = [(1, "http://x.org/", at(0)), (2, "HTTP://User@X.ORG:80/a", at(1)), (3, "http://sub.x.org", at(4.9)), (4, "http://x.org", at(5)),
                (5, "http://x.org", None), (6, None, at(3)), (7, "not a url", at(3)), (8, "http://localhost/x", at(3)), (9, "http://x.org", at(30)),
                (None, "http://x.org", at(3)), (9, "http://x.org", at(30)), (10, "http://y.org", at(3)), (11, "http://z.org", at(3))]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp").selectExpr("*", "1 AS entry", "2 AS since")
    got = {r["page_id"]: (r["listed"], r["entry"], r["since"]) for r in urlfilter.judge(c, d).collect()}
    yes = lambda since: (True, "x.org", at(since))
    no = (False, None, None)
    assert got == {1: no, 2: yes(1), 3: yes(1), 4: no, 5: no, 6: no, 7: no, 8: (True, "localhost", at(0)), 9: yes(9), None: yes(1), 10: no, 11: no}
    assert urlfilter.judge(c, d).count() == 12
    assert urlfilter.judge(c.limit(0), d).collect() == []
    assert not any(r["listed"] for r in urlfilter.judge(c, d.limit(0)).collect())


def test_plan_runs_no_python(spark):
    plan = urlfilter.op7_query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
