"""Fetching from a server of this test, and files."""

import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from domscope.sources import fetch, shared
from domscope.workspace import Workspace


class Site(BaseHTTPRequestHandler):
    asked: list[str] = []

    def special(self):
        if self.path == "/slow":
            time.sleep(1.5)
        body = {"/pdf": b"%PDF\x00\xff", "/large": b"x" * 20_000_000 + b"end", "/busy": b"at last", "/slow": b"late", "/plain": b"text"}[self.path]
        self.send_response(503 if self.path == "/busy" and Site.asked.count("/busy") < 3 else 200)
        if self.path != "/large":
            self.send_header("Content-Type", {"/pdf": "application/pdf", "/plain": "Text/Plain"}.get(self.path, "text/html"))
        self.end_headers()
        try:
            self.wfile.write(body)
        except OSError:
            pass

    def do_GET(self):
        Site.asked.append(self.path)
        if self.path in ("/pdf", "/large", "/busy", "/slow", "/plain"):
            self.special()
            return
        if self.path == "/moved":
            self.send_response(302)
            self.send_header("Location", "/page")
            self.end_headers()
            return
        self.send_response(200 if self.path == "/page" else 404)
        self.end_headers()
        self.wfile.write("<p>ü".encode() + b"\xff" if self.path == "/page" else b"gone")

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def site():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_fetch(spark, site):
    urls = [
        f"{site}/page", f"{site}/moved", f"{site}/none", f"{site}/page", "http://127.0.0.1:1/", "ftp://x/",
        "file:///etc/passwd", None, "",
    ]
    got = {
        r["url"]: (r["final_url"], r["status"], r["html"])
        for r in fetch.pages(spark.createDataFrame([(u,) for u in urls], "url string"), timeout=5).collect()
    }
    assert got[f"{site}/page"] == (
        f"{site}/page", 200, "<p>ü�",
    ) and got[f"{site}/moved"] == (f"{site}/page", 200, "<p>ü�")
    assert got[f"{site}/none"] == (f"{site}/none", 404, "")
    assert all(
        got[u] == (u, -1, "") for u in ("http://127.0.0.1:1/", "ftp://x/", "file:///etc/passwd", "")
    ) and len(got) == 7
    assert Site.asked.count("/moved") == 1
    assert fetch.pages(spark.createDataFrame([], "url string")).collect() == []


def test_slow_binary_large_and_busy_answers(spark, site):
    frame = lambda *paths: spark.createDataFrame([(f"{site}{p}",) for p in paths], "url string").coalesce(1)
    read = lambda df: {r["url"].removeprefix(site): r for r in df.collect()}
    got = read(fetch.pages(frame("/pdf", "/large", "/slow", "/plain"), timeout=0.5))
    assert len(got["/large"].html) == 20_000_003 and got["/large"].html.endswith("end") and got["/large"].content_type == ""
    assert got["/pdf"].content_type == "application/pdf" and got["/pdf"].html.startswith("%PDF")
    assert (got["/slow"].status, got["/slow"].html) == (-1, "") and "timed out" in got["/slow"].error
    got = read(fetch.pages(frame("/pdf", "/large", "/plain"), timeout=5, only_html=True, most=1000))
    assert (got["/pdf"].status, got["/pdf"].html, got["/pdf"].error) == (200, "", "not text")
    assert (got["/large"].html, got["/large"].error) == ("", "more than 1000 bytes") and got["/plain"].html == "text"
    assert read(fetch.pages(frame("/busy"), timeout=5))["/busy"].status == 503
    Site.asked.clear()
    assert read(fetch.pages(frame("/busy"), timeout=5, tries=4, wait=0.01))["/busy"].html == "at last"
    assert Site.asked.count("/busy") == 3


def test_pace_and_what_is_done(spark):
    """Answers tell when they were asked for; all are of one host, so one task asks them one by one."""
    urls = spark.createDataFrame([(f"http://one.example/p{k}",) for k in range(4)], "url string")
    done = spark.createDataFrame([("http://one.example/p0", 200)], "url string, status int")
    asked = lambda url, _: fetch.Answer(url, 200, str(time.monotonic()))
    got = fetch.pages(urls, pace=0.3, done=done, ask=asked).collect()
    assert sorted(r.url[-1] for r in got) == ["1", "2", "3"]
    at = sorted(float(r.html) for r in got)
    assert all(b - a >= 0.25 for a, b in zip(at, at[1:], strict=False))


def test_a_broken_run_of_fetching_goes_on(spark, site, tmp_path):
    (tmp_path / "urls.txt").write_text(f"{site}/page\n{site}/plain\nhttp://127.0.0.1:1/\n")
    work = Workspace(spark, tmp_path)
    out = str(tmp_path / "pages")
    ask = lambda: work.fetch(out, urls_file=str(tmp_path / "urls.txt"), timeout=5, pace=0, tries=1)
    assert ask() == {"pages": 3, "failed": 1}
    Site.asked.clear()
    assert ask() == {"pages": 3, "failed": 1} and Site.asked == []


def test_shared_storage(spark):
    """Written tables go when they are discarded, and frames made of them with them."""
    import os

    a = shared.written(spark.range(5).selectExpr("id AS x"))
    folder = shared._folders[a][0]
    assert a.count() == 5 and os.path.isdir(folder) and folder.startswith(shared.shared_dir(spark))
    b = shared.kept_with(a.where("x > 2"), a)
    assert b.count() == 2
    c = shared.written(b, b)
    assert c.count() == 2 and not os.path.isdir(folder)
    shared.discard(c, c)


def test_a_cluster_needs_a_shared_folder():
    class Fake:
        class conf:
            @staticmethod
            def get(_, default=None):
                return default

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        shared.shared_dir(Fake)
    Fake.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="checkpoint"):
        shared.shared_dir(Fake)
    Fake.sparkContext.master = "local[4]"
    assert shared.shared_dir(Fake)
