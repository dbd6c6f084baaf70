"""Documents to page images and images to text, behind interfaces: the programs that do it are not part of this library."""

from __future__ import annotations

import shutil
import subprocess
import tempfile
import time
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models import Calls, Reader


class Renderer(Protocol):
    def pages(self, document: bytes, scale: float) -> Iterator[tuple[int, bytes]]:
        """Page numbers from 1 and PNG images of a PDF, at a scale of its points."""


def slides_to_pdf(source: str, folder: str, program: str = "libreoffice", timeout: float = 300, run=subprocess.run) -> tuple[str, str | None]:
    """(status, error) of converting slides with an office program, which must leave the PDF under the source's stem."""
    try:
        done = run([shutil.which(program) or shutil.which("soffice") or program, "--headless", "--convert-to", "pdf", "--outdir", folder, source], capture_output=True, timeout=timeout)
    except FileNotFoundError:
        return "failed", f"{program} is not installed"
    except subprocess.TimeoutExpired:
        return "failed", f"no result after {timeout:g} s"
    if done.returncode:
        said = (done.stderr or done.stdout or b"").decode("utf-8", "replace").strip()
        return "failed", f"exit code {done.returncode}: {said}"[:500].rstrip(": ")
    wanted = Path(folder) / f"{Path(source).stem}.pdf"
    return ("success", None) if wanted.exists() else ("failed", f"{program} left no {wanted.name}")


def page_name(prefix: str, number: int) -> str:
    """The name of a page's image."""
    return f"{prefix}_page_{number:04d}.png"


def zoom(dpi: int) -> float:
    """Scale of a page at 72 points an inch."""
    if dpi < 1:
        raise ValueError("dpi must be at least 1")
    return dpi / 72.0


def as_pdf(kind: str, path: str, content: bytes, convert=slides_to_pdf) -> bytes:
    """A document as PDF: itself, or for slides what an office program makes of it in a folder of its own."""
    if kind == "pdf":
        return content
    if kind != "slides":
        raise ValueError(f"unsupported kind of document: {kind}")
    with tempfile.TemporaryDirectory(prefix="slides-") as folder:  # the program's own files, gone at once
        source = Path(folder) / Path(path).name
        source.write_bytes(content)
        status, error = convert(str(source), folder)
        if status != "success":
            raise RuntimeError(error)
        return (Path(folder) / f"{source.stem}.pdf").read_bytes()


_PAGES = "path string, page bigint, name string, image binary, status string, error string"


def render(documents: DataFrame, make: Callable[[], Renderer], dpi: int = 200, wanted: list[int] | None = None, convert=slides_to_pdf) -> DataFrame:
    """``path, page, name, image, status, error`` of ``path, content`` and, if given, ``kind`` (pdf or slides, which are
    converted first); a document that fails is one failed row, pages out of range are left out. name is the image's file,
    in the folder of its document."""
    pages, scale = set(wanted or []), zoom(dpi)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        renderer = make()
        for pdf in parts:
            kinds = pdf["kind"] if "kind" in pdf else ["pdf"] * len(pdf)
            for path, kind, content in zip(pdf["path"], kinds, pdf["content"]):
                stem = Path(path).stem
                try:
                    found = renderer.pages(as_pdf(kind, path, content, convert), scale)
                    rows = [(path, n, f"{_folder(stem)}/{page_name(stem, n)}", image, "success", None) for n, image in found if not pages or n in pages]
                except Exception as error:
                    rows = [(path, None, None, None, "failed", str(error)[:500])]
                yield pd.DataFrame(rows, columns=["path", "page", "name", "image", "status", "error"]).astype({"page": "Int64"})

    columns = ["path", "content", *(["kind"] if "kind" in documents.columns else [])]
    return documents.select(*columns).mapInPandas(run, _PAGES)


def _folder(stem: str) -> str:
    return stem.replace("/", "_").replace("\\", "_").strip() or "document"


def run_summary(rendered: DataFrame) -> DataFrame:
    """``path, status, pages, error``: what became of every document."""
    return rendered.groupBy("path").agg(F.when(F.count_if(F.col("status") == "failed") > 0, "failed").otherwise("success").alias("status"), F.count("page").alias("pages"), F.max("error").alias("error"))


def read_pages(images: DataFrame, make: Callable[[], Reader], done: DataFrame | None = None, calls: Calls | None = None) -> DataFrame:
    """``path, text, status, error, processed_at, duration_seconds`` of ``path, image``; images with a result are skipped,
    failures are rows."""
    calls = calls or Calls()
    todo = images if done is None else images.join(done.where(F.col("status") == "success").select("path"), "path", "left_anti")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, call = make(), calls.begin()
        for pdf in parts:
            rows = []
            for path, image in zip(pdf["path"], pdf["image"]):
                began, at = time.monotonic(), datetime.now(UTC).isoformat()
                try:
                    rows.append((path, call(lambda image=image: reader.read(image)), "success", None, at, time.monotonic() - began))
                except Exception as error:
                    rows.append((path, None, "failed", str(error)[:500], at, time.monotonic() - began))
            yield pd.DataFrame(rows, columns=["path", "text", "status", "error", "processed_at", "duration_seconds"])

    return todo.select("path", "image").mapInPandas(run, "path string, text string, status string, error string, processed_at string, duration_seconds double")
