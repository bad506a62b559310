import hashlib
import itertools
import re
from pathlib import PurePosixPath
from urllib.parse import urljoin, urlparse

from recordmill.functions import urls as U

BASES = ["http://h.com/d1/d2/p.html?x=1#t", "https://h.com", "http://h.com/", "http://h.com/a/b/", "http://h.com/a?q"]
HREFS = [
    "", "#f", "?q=2", "/abs", "/a/../b", "rel", "../up", "./x/", "//host/p?q#f", "http://o/x", "mailto:a@b.org", "https://z/y",
    "../../../q", ".", "..", "a//b", "x y.pdf", "/a/./b/..", "  /lead", "/ne\nw", "javascript:void(0)", "a;p?q", "é/ü.pdf",
]
URLS = [
    "http://x.org/a/b.tar.GZ?q=1", "http://x.org/.bashrc", "http://x.org/a.", "http://x.org/a.pdf/", "http://x.org/a.pdf;v=1",
    "http://x.org/my doc.PDF", "/a", "x.pdf", "", "http://X.org:80/wp-content/Uploads/2025/scan", "//cdn.net/q.docx#p",
    "http://x.org", "http://x.org/a..pdf", "http://x.org/d.pdf/.", "https://y.x.org/z.csv?dl=1",
]


def test_url_join(apply):
    pairs = list(itertools.product(BASES, HREFS))
    got = apply(lambda base, href: U.url_join(U.url_parts(base), href), pairs)
    assert {p: g for p, g in zip(pairs, got)} == {(b, h): urljoin(b, h) for b, h in pairs}


def test_names_and_types(apply):
    names = [PurePosixPath(urlparse(u).path).name for u in URLS]
    assert apply(U.file_name, URLS) == names
    suffixes = [name[i + 1 :].lower() if 0 < (i := name.rfind(".")) < len(name) - 1 else "" for name in names]
    assert apply(U.file_type, URLS) == [s or "unknown" for s in suffixes]


def test_domain_and_document(apply):
    assert apply(lambda u: U.in_domain(u, "x.org"), URLS) == [urlparse(u).netloc.lower().endswith("x.org") for u in URLS]
    assert apply(lambda u: U.in_domain(u, "x.org"), ["http://evilx.org/", None]) == [True, False]
    got = apply(U.looks_like_document, URLS)
    assert [u for u, hit in zip(URLS, got) if hit] == [
        "http://x.org/a.pdf/", "http://x.org/a.pdf;v=1", "http://x.org/my doc.PDF", "x.pdf",
        "http://X.org:80/wp-content/Uploads/2025/scan", "//cdn.net/q.docx#p", "http://x.org/a..pdf", "http://x.org/d.pdf/.",
        "https://y.x.org/z.csv?dl=1",
    ]


def test_safe_filename(apply):
    pairs = [("http://x/a b.pdf", "t"), ("http://x/?p=2", "Plan é 2025 " + "x" * 80)]
    digest = hashlib.sha1(b"http://x/?p=2").hexdigest()[:10]
    made = re.sub(r"[^A-Za-z0-9._-]+", "_", f"{pairs[1][1][:60]}-{digest}.bin")
    assert apply(lambda url, title: U.safe_filename(url, title, 60, 10), pairs) == ["a_b.pdf", made]
    whole = re.sub(r"[^A-Za-z0-9._-]+", "_", f"{pairs[1][1]}-{hashlib.sha1(b'http://x/?p=2').hexdigest()}.bin")
    assert apply(U.safe_filename, pairs) == ["a_b.pdf", whole]


def test_weak_titles(apply):
    pairs = [("ok", "http://x/big_scan-copy.pdf"), ("okay", "http://x/y.pdf"), ("", "http://x/")]
    assert apply(U.title_or_file_name, pairs) == ["big scan copy.pdf", "okay", ""]
