"""Inputs of whole runs."""

import json

FULL = {
    "suppress": ["Drop"], "hashing_with_salt": ["Salted"], "hashing_without_salt": ["Hashed"], "charcloak": ["Cloak"],
    "masking": [{"column": "Mail", "regex_patterns": [{"type": "before", "delimiter": "@"}]}],
    "tokenization": [{"column": "City", "prefix": "C", "digits": 3}], "fpe": [{"column": "Phone", "format": "digits"}],
    "encrypt": ["Note", {"Code": {"format_preserving": True}}],
    "quasi_identifiers": {"numerical": [{"column": "Age", "type": "int"}], "categorical": ["Gender"]},
    "size": {"Age": 2, "Other": "x"}, "k_anonymize": {"k": 2}, "suppression_limit": 0.5, "output_path": "out.csv",
}


def folder(tmp_path, body, csv):
    (tmp_path / "config").mkdir()
    (tmp_path / "data").mkdir()
    (tmp_path / "config" / "b.json").write_text("{")
    (tmp_path / "config" / "a.json").write_text(json.dumps({"data_type": "t", "t": body}))
    (tmp_path / "data" / "d.csv").write_text(csv, encoding="utf-8")
    return tmp_path


HEADER = "Drop,Salted,Hashed,Cloak,Mail,City,Phone,Note,Code,Age,Gender\n"


def csv_rows(n=40):
    return HEADER + "".join(f'x,s,h,Ab{i % 10},u{i}@m.org,"Town, {i % 3}",555{i:04d},note {i},Zz{i},{20 + i % 8},{"Male" if i % 2 else "Female"}\n' for i in range(n)) + "\n  \n"
