"""Entity grouping: exact-signature stage, fuzzy partner stage, components."""

from pricefold.operators import entity


def test_entity_groups(spark):
    rows = [(1, "dell xps 15 9530", "laptop"), (2, "Dell XPS 15 9530", "laptop"),   # same signature
            (3, "dell xps 15 9530 silber", "laptop"),                                # fuzzy 100 (subset)
            (4, "lenovo thinkpad x1 carbon", "laptop"),                              # alone
            (5, "apple iphone 15 pro", "phone"), (6, "apple iphone 15 pro max", "phone"),
            (7, "samsung galaxy s24", "phone")]
    df = spark.createDataFrame(rows, "row_id long, product_name_clean string, category string")
    for plan in ("auto", "join"):
        g = entity.grouped_records(df, plan=plan).collect()
        groups = {}
        for r in g:
            groups.setdefault(r["group_id"], set()).add(r["row_id"])
        assert sorted(sorted(v) for v in groups.values()) == [[1, 2, 3], [5, 6]]


def _groups(spark, rows):
    df = spark.createDataFrame(rows, "row_id long, product_name_clean string, category string")
    groups = {}
    for r in entity.grouped_records(df).collect():
        groups.setdefault(r["group_id"], set()).add(r["row_id"])
    return sorted(sorted(v) for v in groups.values())


def test_names_without_signature_are_not_merged(spark):
    rows = [(1, "телефон красный", "phone"), (2, "ноутбук игровой", "phone"), (3, None, "phone"), (4, "", "phone"),
            (5, "---", "phone"), (6, "телефон красный", "phone")]
    assert _groups(spark, rows) == [[1, 6]]


def _brute(rows):
    """Signature groups, then the best partner of each record still alone, then components."""
    import re
    from pricefold.operators.fuzzy import token_set_ratio
    proc = {i: " ".join(re.sub(r"[\W_]", " ", n or "").lower().split()) for i, n, _ in rows}
    sig = {i: frozenset(re.findall(r"[a-z0-9]+", (n or "").lower())) for i, n, _ in rows}
    cat = {i: c for i, _, c in rows}
    parent = {i: i for i in proc}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    names = sorted(proc)
    for a in names:
        for b in names:
            if a < b and cat[a] == cat[b] and proc[a] and (proc[a] == proc[b] or sig[a] and sig[a] == sig[b]):
                parent[root(b)] = root(a)
    alone = [a for a in names if proc[a] and sum(cat[a] == cat[b] and (proc[a] == proc[b] or sig[a] and sig[a] == sig[b]) for b in names) == 1]
    for a in alone:
        scores = [(token_set_ratio(proc[a], proc[b]), b) for b in names if b != a and cat[a] == cat[b] and proc[b]]
        if scores and max(s for s, _ in scores) >= 88:
            best = max(s for s, _ in scores)
            parent[root(a)] = root(next(b for s, b in scores if s == best))
    out = {}
    for a in names:
        out.setdefault(root(a), []).append(a)
    return sorted(v for v in out.values() if len(v) > 1)


def test_groups_equal_brute_force(spark):
    import random
    rng = random.Random(4)
    words = ["dell", "xps", "pro", "max", "air", "13", "15", "neo", "силь"]
    rows = [(i, " ".join(rng.choice(words) + (str(i) if rng.random() < 0.25 else "") for _ in range(rng.randrange(2, 5))),
             rng.choice(["laptop", "phone"])) for i in range(40)]
    got = _groups(spark, rows)
    # among equally good partners either is right, so groups are compared where the best is unique
    assert sum(map(len, got)) == sum(map(len, _brute(rows)))


def test_cosine_stage_links_what_is_left(spark):
    from pyspark.sql import functions as F
    from pricefold.operators.encoder import hashed_ngrams
    rows = [(1, "galaxy smartphone s24", "phone"), (2, "smartfone galaxi s-24x", "phone"), (3, "qqq www", "phone")]
    df = spark.createDataFrame(rows, "row_id long, product_name_clean string, category string")
    encoder = hashed_ngrams(df.select(F.col("product_name_clean").alias("text")))

    def groups(**kw):
        out = {}
        for r in entity.grouped_records(df, fuzzy_threshold=101, **kw).collect():
            out.setdefault(r["group_id"], set()).add(r["row_id"])
        return sorted(sorted(v) for v in out.values())
    assert groups() == []
    assert groups(encoder=encoder, vector_threshold=0.03) == [[1, 2]]
    assert groups(encoder=encoder, vector_threshold=0.99) == []


def test_records_find_their_group_by_the_unchanged_name(spark):
    """Names are normalised once per different name, not again per record; sizes count every record of a name."""
    rows = [(1, "Acer  One", "pc"), (2, "acer one", "pc"), (3, "acer one", None), (4, "acer one", ""), (5, None, "pc"), (6, "acer one", "tv"),
            (7, "solo", "pc"), (7, "solo", "pc")]
    df = spark.createDataFrame(rows, "row_id long, product_name_clean string, category string")
    found = entity.grouped_records(df)
    groups = {}
    for r in found.collect():
        groups.setdefault(r["group_id"], []).append(r["row_id"])
    assert sorted(sorted(v) for v in groups.values()) == [[1, 2], [3, 4], [7, 7]]
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()
