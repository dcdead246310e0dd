"""Source files in the five shapes, made by rule."""

from __future__ import annotations

import json
from pathlib import Path

COMPANIES = 100


def company(i: int) -> str:
    return f"C{i:03d}"


def write_period_xml(path: Path, n: int = 50, prefix: str = "") -> None:
    p = f"{prefix}:" if prefix else ""
    space = f' xmlns:{prefix}="http://example.org/x"' if prefix else ' xmlns="http://example.org/x"'
    body = "".join(
        f"<{p}entity><{p}identifier>{company(i)}</{p}identifier>"
        + "".join(
            f'<{p}financials period="{period}"><{p}revenue>{base + 7 * i}</{p}revenue>'
            f"<{p}profit>{i}</{p}profit></{p}financials>"
            for period, base in (("CY", 3000), ("PY", 2000))
        )
        + f"</{p}entity>"
        for i in range(1, n + 1)
    )
    path.write_text(f"<{p}xbrl{space}>{body}</{p}xbrl>")


def write_company_xml(path: Path, n: int = COMPANIES, renamed: tuple[int, ...] = ()) -> None:
    body = "".join(
        f"<Company><CompanyID>{company(i)}</CompanyID><Details>"
        f"<Name>{'Renamed' if i in renamed else 'Company'}_{i}</Name>"
        f"<Financials><Revenue>{1000 + i}</Revenue><Year>2023</Year></Financials></Details></Company>"
        for i in range(1, n + 1)
    )
    path.write_text(f"<Companies>{body}</Companies>")


def write_nested_json(path: Path, n: int = COMPANIES) -> None:
    records = [
        {"company": {"company_id": company(i), "details": {
            "year": 2023,
            "financials": {"revenue": 1000 + i, "currency": ("USD", "EUR", "INR")[i % 3]},
        }}}
        for i in range(1, n + 1)
    ]
    path.write_text(json.dumps(records, indent=2))


def write_period_json(path: Path, n: int = 50) -> None:
    records = [
        {"company_id": company(i), "financials": {
            "CY": {"revenue": 2000 + i}, "PY": {"revenue": 1000 + i}}}
        for i in range(1, n + 1)
    ]
    path.write_text(json.dumps(records, indent=2))


def write_csv(path: Path) -> None:
    """Two tables of 80 and 20 lines, three bad lines, three metadata lines, CRLF."""
    lines = [",company_id,profit,year,remarks"]
    for i in range(1, 81):
        year = {15: "20x3", 26: "20X3"}.get(i, "2023")
        name = "" if i == 11 else company(i)
        lines.append(f',{name},"{100 + i},extra",{year},text_{i}|extra')
    lines += [",,,,", ",,,,", "company_id,profit,year,remarks,"]
    lines += [f'{company(i)},"{100 + i},extra",2023,text_{i}|extra,' for i in range(81, 101)]
    lines += [",,,,", ",,,,", ",enity name ,Example Ltd,,", ",period start date ,01-01-2019,,",
              ",period end date,31-12-2019,,"]
    path.write_bytes(("\r\n".join(lines) + "\r\n").encode())


def write_all(folder: Path, renamed: tuple[int, ...] = ()) -> dict[str, tuple[str, str]]:
    """Write all five sources; name -> (kind, path)."""
    folder.mkdir(parents=True, exist_ok=True)
    files = {
        "xbrl_xml": ("xml", "periods.xml"), "hierarchical_xml": ("xml", "companies.xml"),
        "financials_json": ("json", "nested.json"), "period_json": ("json", "periods.json"),
        "complex_csv": ("csv", "tables.csv"),
    }
    write_period_xml(folder / "periods.xml")
    write_company_xml(folder / "companies.xml", renamed=renamed)
    write_nested_json(folder / "nested.json")
    write_period_json(folder / "periods.json")
    write_csv(folder / "tables.csv")
    return {name: (kind, str(folder / file)) for name, (kind, file) in files.items()}
