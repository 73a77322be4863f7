"""Kept model answers: each distinct text is asked once over runs, failures and killed tasks."""

import os
import subprocess
import sys
import threading
import time

from pyspark.sql import functions as F

from foliomill.operators import answers, driver

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def counting(marks):
    """A model that leaves a mark for each call."""

    def make():
        def call(text):
            with open(f"{marks}/{text.strip()[:40].encode().hex()}", "a") as f:
                f.write("x")
            return text.upper()

        return call

    return make


def calls(marks):
    return {bytes.fromhex(n).decode(): len(open(f"{marks}/{n}").read()) for n in os.listdir(marks)}


def test_each_distinct_text_is_asked_once(spark, tmp_path):
    marks, store = tmp_path / "m", str(tmp_path / "store")
    marks.mkdir()
    texts = ["a", "b", "a", None, "", " 　", "c"] * 20
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], ["id", "text", "a.b"]).repartition(5)
    got = answers.ask(df, counting(marks), store, flush=2)
    assert got.columns == ["id", "text", "a.b", "model_text", "model_ok", "model_error"] and got.count() == len(texts)
    assert {(r["text"], r["model_text"], r["model_ok"]) for r in got.collect()} == {("a", "A", True), ("b", "B", True), ("c", "C", True), (None, None, True), ("", "", True), (" 　", " 　", True)}
    more = df.unionByName(spark.createDataFrame([(999, "d", 1)], df.schema))
    answers.ask(more, counting(marks), store).count()
    assert calls(marks) == {"a": 1, "b": 1, "c": 1, "d": 1}
    answers.ask(df, counting(marks), store, prompt="another").count()
    assert calls(marks) == {"a": 2, "b": 2, "c": 2, "d": 1}
    answers.compact(spark, store)
    answers.ask(more, counting(marks), store).count()
    assert calls(marks)["d"] == 1 and answers.kept(spark, store).count() == 4
    assert answers.ask(df.limit(0), counting(marks), str(tmp_path / "none")).count() == 0


def test_failures_are_told_and_tried_by_the_next_run(spark, tmp_path):
    store = str(tmp_path / "store")
    df = spark.createDataFrame([("good",), ("bad",)], "text string")

    def make():
        def call(text):
            if text == "bad":
                raise ValueError("no")
            return text + "!"

        return call

    got = {r["text"]: tuple(r)[1:] for r in answers.ask(df, make, store, attempts=2, pause=0.01).collect()}
    assert got == {"good": ("good!", True, None), "bad": ("bad", False, "no")}
    assert answers.ask(df, make, store, attempts=1, fallback="").where("text = 'bad'").first()["model_text"] == ""
    assert {r[0] for r in answers.ask(df, lambda: lambda t: t + "?", store).select("model_text").collect()} == {"good!", "bad?"}


def test_slow_calls_are_given_up(spark, tmp_path):
    def make():
        return lambda text: time.sleep(60 if text == "slow" else 0) or text

    start = time.time()
    got = answers.ask(spark.createDataFrame([("slow",), ("fast",)], "text string").coalesce(1), make, str(tmp_path / "s"), seconds=0.5, attempts=1)
    assert {r["text"]: r["model_ok"] for r in got.collect()} == {"slow": False, "fast": True}
    assert "0.5" in got.where("not model_ok").first()["model_error"] and time.time() - start < 50


def test_calls_of_a_task_run_side_by_side(spark, tmp_path):
    def make():
        barrier = threading.Barrier(4)  # calls one after another would break it
        return lambda text: str(barrier.wait(20) >= 0) + text

    df = spark.range(8).select(F.col("id").cast("string").alias("text")).coalesce(1)
    assert answers.ask(df, make, str(tmp_path / "s"), tasks=1, attempts=1, at_once=4, flush=4).where("model_ok").count() == 8


def test_cleaning_asks_equal_chunks_once(spark, tmp_path):
    marks, store = tmp_path / "m", str(tmp_path / "store")
    marks.mkdir()
    docs = spark.createDataFrame([(i, "same words here.\n") for i in range(6)] + [(7, "others here.\n")], "doc_id long, text string")
    first = sorted(map(tuple, driver.clean_documents(docs, counting(marks), store=store).collect()))
    second = sorted(map(tuple, driver.clean_documents(docs, counting(marks), store=store).collect()))
    assert first == second and sorted(calls(marks).values()) == [1, 1]


SCRIPT = """
import os, sys
from pyspark.sql import SparkSession, functions as F
from foliomill.operators import answers
base = sys.argv[1]
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", base + "/shared").getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def make():
    def call(text):
        if text == "t17" and not os.path.exists(base + "/died"):
            open(base + "/died", "w").close()
            os._exit(1)
        with open(f"{base}/m/{text.encode().hex()}", "a") as f:
            f.write("x")
        return text + "!"
    return call

df = spark.range(80).select(F.concat(F.lit("t"), F.col("id") % 40).alias("text"))
for _ in range(2):
    got = answers.ask(df, make, base + "/store", flush=1, at_once=1, every=0)
    assert got.where("model_text = text || '!'").count() == 80
spark.stop()
"""


def test_a_killed_task_goes_on_where_it_was(tmp_path):
    (tmp_path / "m").mkdir()
    env = {**os.environ, "PYTHONPATH": ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")}
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-3000:]
    assert (tmp_path / "died").exists()
    assert calls(tmp_path / "m") == {f"t{i}": 1 for i in range(40)}
