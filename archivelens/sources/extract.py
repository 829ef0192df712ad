"""Text of files of any kind, for scans of personal data (inventory S12, H9, S17).

Office files are archives of XML, which the standard library reads; PDF needs a program.  What can't be read is an
error, never an empty text, so a scan can tell it from a clean file.
"""

from __future__ import annotations

import io
import os
import re
import shutil
import subprocess
import tempfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _docx(data: bytes) -> str:
    """Paragraphs of a document, those in the cells of tables too, a line each."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    return "\n".join("".join(t.text or "" for t in p.iter(f"{_WORD}t")) for p in root.iter(f"{_WORD}p"))


def _xlsx(data: bytes) -> str:
    """Values of all cells that aren't empty, sheet by sheet, a line each."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{_SHEET}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si")]
        number = lambda n: int(re.search(r"(\d+)\.xml$", n)[1])
        out = []
        for name in sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=number):
            for c in ElementTree.fromstring(z.read(name)).iter(f"{_SHEET}c"):
                value = c.findtext(f"{_SHEET}v")
                if c.get("t") == "s" and value is not None:
                    value = shared[int(value)]
                elif c.get("t") == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(f"{_SHEET}t"))
                if value:
                    out.append(value)
    return "\n".join(out)


def run_on_file(command: list[str], data: bytes, suffix: str) -> str:
    """What a program writes to its output for a file of ``data``; ``{}`` in the command is the file's path."""
    if shutil.which(command[0]) is None:
        raise RuntimeError(f"{command[0]} is not available")
    with tempfile.NamedTemporaryFile(suffix=suffix) as f:  # read by a program on this machine, in this call only
        f.write(data)
        f.flush()
        done = subprocess.run([f.name if x == "{}" else x for x in command], capture_output=True, check=False)
    if done.returncode:
        raise RuntimeError(f"{command[0]} failed: {done.stderr.decode('utf-8', 'replace').strip()[:200]}")
    return done.stdout.decode("utf-8", "replace")


READERS = {".docx": _docx, ".xlsx": _xlsx, ".pdf": lambda data: run_on_file(["pdftotext", "-q", "{}", "-"], data, ".pdf")}


def text_of(filename: str, data: bytes) -> str:
    """The text of a file by its suffix; all but office files and PDF are UTF-8. Raises if it can't be read."""
    return READERS.get(os.path.splitext(filename)[1].lower(), lambda d: d.decode("utf-8"))(data)


def extracted(files: DataFrame) -> DataFrame:
    """Files (filename, filepath, content bytes) as filename, filepath, text and error; just one of the last two is null."""
    names = ["filename", "filepath", "text", "error"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for i in range(len(b)):  # a row at a time, as files may be large
                name, path, data = (b.column(k)[i].as_py() for k in range(3))
                try:
                    row = (name, path, text_of(name or "", data or b""), None)
                except Exception as e:  # noqa: BLE001  any fault of a file is that file's result
                    row = (name, path, None, f"{type(e).__name__}: {e}"[:300])
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in row], names)

    return files.select("filename", "filepath", "content").mapInArrow(run, ", ".join(f"{n} string" for n in names))


def scan(files: DataFrame, denylist: list[str] = ()) -> DataFrame:
    """filepath, line, kind, match and context of personal data in files; one that can't be read is ``unscannable`` at line 0."""
    from ..operators import pii

    texts = extracted(files)
    found = pii.findings(texts.filter("error is null"), "filepath", "text", denylist)
    failed = texts.filter("error is not null").select("filepath", F.lit(0).alias("line"), F.lit("unscannable").alias("kind"), F.lit("").alias("match"), F.col("error").alias("context"))
    return found.unionByName(failed)


@dataclass
class CommandConverter:
    """A converter that is a program: pandoc, or any other that writes Markdown to its output."""

    name: str
    command: list[str]
    extensions: tuple[str, ...]

    def convert(self, filename: str, content: bytes) -> str | None:
        suffix = os.path.splitext(filename)[1].lower()
        return run_on_file(self.command, content, suffix) if suffix in self.extensions else None


PANDOC = CommandConverter("pandoc", ["pandoc", "--to", "gfm", "{}"], (".docx", ".html", ".odt", ".rtf"))
