"""Zipped manuscripts, package facts and the command line."""

import json
import zipfile

from inkwell import cli
from inkwell.sources import packages


def epub(path, language="ko", ident="a"):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("mimetype", "application/epub+zip")
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="O/p.opf"/></rootfiles></container>')
        items = "".join(f'<item id="{i}" href="{h}" media-type="application/xhtml+xml"/>' for i, h in (("b", "b.xhtml"), ("a", "a.xhtml"), ("cover", "cover.xhtml"), ("gone", "gone.xhtml")))
        z.writestr("O/p.opf", f'<package xmlns:dc="x"><dc:language>{language}</dc:language><dc:identifier>{ident}</dc:identifier>{items}<itemref idref="cover"/><itemref idref="a"/><itemref idref="b"/><itemref idref="gone"/></package>')
        z.writestr("O/a.xhtml", "<html><head><title>no</title></head><body><nav>no</nav>tail<p>하나  <b>둘</b></p><p>셋</p></body></html>")
        z.writestr("O/b.xhtml", "<html><body><p>넷 &amp; 다섯<p>여섯</body>")
        z.writestr("O/cover.xhtml", "<html><body>cover</body></html>")


def test_packages(spark, tmp_path):
    epub(tmp_path / "1.epub")
    epub(tmp_path / "글 2화.epub")
    (tmp_path / "bad.epub").write_bytes(b"none")
    with zipfile.ZipFile(tmp_path / "x.hwpx", "w") as z:
        z.writestr("Contents/section10.xml", "<s><p><t>뒤</t></p></s>")
        z.writestr("Contents/section2.xml", "<s><p><t>앞</t><t>줄</t></p><p> </p></s>")
    with zipfile.ZipFile(tmp_path / "y.hwpx", "w") as z:
        z.writestr("Contents/section0.xml", "<s/>")
    got = {r.path.rpartition("/")[2]: (r.text, r.error) for r in packages.package_files(spark, str(tmp_path)).collect()}
    assert got["1.epub"] == ("tail\n하나 둘\n셋\n\n넷 & 다섯\n여섯", None) and got["x.hwpx"] == ("앞줄\n뒤", None) and got["y.hwpx"] == (None, "no text")
    assert got["bad.epub"][0] is None and got["bad.epub"][1].startswith("BadZipFile") and len(got) == 5
    found = packages.epub_findings(packages.epub_packages(spark, str(tmp_path)))
    assert {tuple(r) for r in found.collect()} == {("P0", "package", "invalid_zip", 1), ("P1", "metadata", "a", 2), ("P3", "naming", "filename_style", 3)}


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "a.txt").write_text('ⓚ제1화\n"가..."\n[TODO]\nⓚ제2화\n나\n')
    run = lambda *a: (cli.main(list(a)), [json.loads(x) for x in capsys.readouterr().out.splitlines()])[1]
    assert run("inspect-text", str(tmp_path))[0]["chapters"] == 2
    assert run("normalize-typography", str(tmp_path))[0]["text"] == "ⓚ제1화\n“가…”\n[TODO]\nⓚ제2화\n나\n"
    assert [r["classification"] for r in run("brackets", str(tmp_path))] == ["authorial_or_editing_note"]
    (tmp_path / "c.json").write_text(json.dumps([{"find": "나", "replace": "다", "marker": "ⓐ"}, {"find": "", "replace": "x"}], ensure_ascii=False))
    assert [(r["index"], r["field"]) for r in run("validate-changes", str(tmp_path / "c.json"))] == [(1, "find")]
    out = run("apply-changes-text", str(tmp_path), "--changes", str(tmp_path / "c.json"))[0]
    assert out["text"].endswith("ⓚ제2화\n다\n") and out["applied"] == [0] and out["blocked"] == [1]
