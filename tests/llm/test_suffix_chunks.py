from tests.llm.test_suffixes import brute, made
from tilewright.llm import suffixes


def test_few_windows_at_once(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "WINDOWS", 40)
    rows = made(8)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=3000).collect()}
    assert got == brute(rows)
