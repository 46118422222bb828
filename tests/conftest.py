from __future__ import annotations

import sys
import tempfile
import zipfile
from decimal import Decimal
from pathlib import Path
from xml.sax.saxutils import escape

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from grantloom.session import build_session  # noqa: E402


# started on import, so that test modules may build column expressions at their top level
SPARK = build_session(
    "tests",
    "local[4]",
    {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shared-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-"),
    },
)
SPARK.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SPARK
    SPARK.stop()


def D(text: str) -> Decimal:
    return Decimal(text)


def column(spark, values, expression, schema="c string"):
    """Values of a column expression over one-column rows, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[1] for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def write_xlsx(path: Path, rows: list[list], date_columns: tuple[int, ...] = (), shared: bool = False) -> None:
    """A minimal workbook. Numbers are number cells, in ``date_columns`` with a date format."""
    strings: list[str] = []

    def cell(r: int, c: int, value) -> str:
        ref = f"{chr(65 + c)}{r}"
        if value is None:
            return ""
        if isinstance(value, (int, float)):
            style = ' s="1"' if c in date_columns else ""
            return f'<c r="{ref}"{style}><v>{value}</v></c>'
        if shared:
            if value not in strings:
                strings.append(value)
            return f'<c r="{ref}" t="s"><v>{strings.index(value)}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'

    body = "".join(
        f'<row r="{i}">' + "".join(cell(i, j, v) for j, v in enumerate(row)) + "</row>"
        for i, row in enumerate(rows, start=1)
    )
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(
            "xl/workbook.xml",
            f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="A" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f'<Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
        z.writestr(
            "xl/styles.xml",
            f'<styleSheet {ns}><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        )
        if shared:
            items = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
            z.writestr("xl/sharedStrings.xml", f"<sst {ns}>{items}</sst>")
