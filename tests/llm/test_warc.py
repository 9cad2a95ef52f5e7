import hashlib

from tests.conftest import SMALL
from verdance.llm import warc as X
from verdance.session import shared_dir

PAGES = "page_id long, url string, html string"


def stored(spark, rows):
    path = shared_dir(spark, "warc")
    X.write_warc(X.derivatives(X.responses(spark.createDataFrame(rows, PAGES))), path)
    return path, X.read_warc(spark, path).collect()


def fields(text):
    return dict(line.split(": ", 1) for line in text.split("\r\n") if ": " in line)


def test_records_are_linked_and_whole(spark):
    html = "<html><head><style>x{}</style><title>A &amp; B</title></head><body><p>é  one<br>two</p><!-- no --><script>1<2</script><b>x</b>y &lt;z&gt;</body></html>"
    path, records = stored(spark, [(7, "http://a.example/x", html)])
    heads = {fields(r.headers)["WARC-Type"]: (fields(r.headers), r.block) for r in records}
    source = X.responses(spark.createDataFrame([(7, "http://a.example/x", html)], PAGES)).first()
    assert set(heads) == {"metadata", "conversion"}
    for head, block in heads.values():
        assert head["WARC-Refers-To"] == source.record_id
        assert head["WARC-Refers-To-Target-URI"] == head["WARC-Target-URI"] == "http://a.example/x"
        assert head["WARC-Source-Payload-Digest"] == "sha256:" + hashlib.sha256(html.encode()).hexdigest()
        assert int(head["Content-Length"]) == len(block.encode())
        assert head["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block.encode()).hexdigest()
    assert heads["conversion"][1] == "A & B\né one\ntwo\nxy <z>"
    meta = fields(heads["metadata"][1].replace("source-header: ", "source-header", 1))
    assert meta["conversion-record-id"] == heads["conversion"][0]["WARC-Record-ID"]
    assert meta["source-header"] == "Content-Type: text/html; charset=utf-8"
    assert len({h["WARC-Record-ID"] for h, _ in heads.values()} | {source.record_id}) == 3


def test_files_are_records_one_after_the_other(spark):
    path, records = stored(spark, [(i, f"u{i}", f"<p>{'x ' * i}</p>") for i in range(30)])
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect()).encode()
    seen = 0
    while text:  # as any WARC reader goes: headers, then so many bytes, then two line ends
        head, text = text.split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\n")
        size = int(fields(head.decode())["Content-Length"])
        assert text[size : size + 4] == b"\r\n\r\n"
        text, seen = text[size + 4 :], seen + 1
    assert seen == 60 == len(records)


def test_awkward_pages(spark):
    rows = [
        (None, None, None), (1, "", ""), (2, "u\r\nWARC-Type: evil", "<p>a\r\n\r\nWARC/1.1\r\nb</p>"), (2, "u", "x"), (2, "u", "x"),
        (3, "u3", "<p>" + "long " * 50_000), (4, "u4", "<script>never closed"), (5, "u5", "a < b && c > d"),
    ]
    _, records = stored(spark, rows)
    assert len(records) == 2 * len(rows)
    df = spark.createDataFrame([(r.headers, r.block) for r in records], "headers string, block string")
    summary = X.derivative_summary(df).collect()
    assert all(r.intact and r.content_length == r.n_bytes for r in summary)
    assert {r.kind for r in summary} == {"metadata", "conversion"}
    texts = {r.target_uri: x.block for r, x in zip(summary, records) if r.kind == "conversion"}
    assert texts["uWARC-Type: evil"] == "a WARC/1.1 b" and texts["u5"] == "a < b && c > d"
    assert stored(spark, [])[1] == []
    extra = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS plain", "2 AS block", "3 AS record_id")
    assert X.derivatives(X.responses(extra)).count() == 2 * len(rows)


def test_same_pages_give_same_records(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    once = X.derivatives(X.responses(pages)).select("record_id").collect()
    assert sorted(once) == sorted(X.derivatives(X.responses(pages.repartition(7))).select("record_id").collect())
