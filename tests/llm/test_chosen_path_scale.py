"""Chosen-path joins store whole sets of pairs to confirm only, and a set meets its tokens and bitmap once."""

from pyspark.sql import functions as F

from tablelab import session
from tablelab.llm import chosen_path, jaccard


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_sets_that_no_pair_asks_for_are_not_stored_whole(spark, monkeypatch):
    shared = "one two three four five six seven eight nine ten"
    texts = [f"{shared} " + " ".join(f"w{i}x{j}" for j in range(6)) for i in range(30)]  # much in common, no links
    texts += [" ".join(f"c{j}" for j in range(60)), " ".join(f"c{j}" for j in range(60)) + " more"]
    stored, plain = [], session.stage

    def stage(df, name="stage", schema=None):
        out = plain(df, name, schema)
        if name == "sets":
            stored.append(out)
        return out

    monkeypatch.setattr(session, "stage", stage)
    got = {r["doc_id"]: r["component_id"] for r in chosen_path.join_groups(table(spark, texts)).collect()}
    assert got == {i: min(i, 30) for i in range(32)}
    whole = {r["sig"] for s in stored for r in s.where("members is not null").select("sig").collect()}
    assert 2 <= len(whole) < 32


def test_a_set_meets_its_tokens_once(spark):
    prints = spark.createDataFrame([(s, bytes(range(s, s + 4)) * chosen_path.TOKENS) for s in range(20)], "sig long, tokens binary")
    rows = spark.range(20).select(F.col("id").alias("sig")).crossJoin(spark.range(30).select(F.col("id").alias("node"))).select("node", "sig")
    nodes = spark.range(30).select(F.col("id").alias("node"))
    out = chosen_path.next_nodes(rows, nodes, prints, 85)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join Inner, (sig" in line]
    groups = [i for i, line in enumerate(plan.splitlines()) if "collect_list" in line]
    assert joins and groups and joins[0] < groups[0]  # grouped by set below the join
    pick = F.filter(F.sequence(F.lit(0), F.lit(chosen_path.TOKENS - 1)), lambda j: F.pmod(F.xxhash64("node", j), F.lit(85 * chosen_path.TOKENS)) < 100)
    direct = rows.join(nodes.select("node", F.explode(pick).alias("position")), "node").join(prints, "sig")
    direct = direct.select(chosen_path._child(F.col("node"), F.col("position"), "tokens").alias("node"), "sig")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, direct.collect()))


def test_mapped_sets_have_bitmaps_and_members_where_asked(spark):
    docs = table(spark, [" ".join(f"a{i}b{j}" for j in range(9)) for i in range(6)] + [None, ""])
    rows = jaccard.sizes(docs, 5)
    every = rows.where("sig is not null").select("sig")
    one = rows.where("doc_id = 2").select("sig")
    plain = {r["sig"]: bytes(r["members"]) for r in jaccard.whole_sets(docs, rows.select("doc_id", "sig"), every, 5).collect()}
    mixed = jaccard.whole_sets(docs, rows.select("doc_id", "sig"), one, 5, mapped=every).collect()
    assert len(plain) == len(mixed) == 6
    asked = one.first()["sig"]
    assert {r["sig"]: bytes(r["members"]) for r in mixed if r["members"] is not None} == {asked: plain[asked]}
    assert all(len(r["bits"]) == 32 and r["n"] == 5 for r in mixed)
