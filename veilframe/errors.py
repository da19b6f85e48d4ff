"""Structured errors: a code, what it means to the caller, and the HTTP status to answer with."""

from __future__ import annotations

# Fixed values, which callers of a run rely on: the codes and their HTTP statuses.
HTTP_STATUS: dict[str, int] = {
    "CONFIG_NOT_FOUND": 400,
    "CONFIG_PARSE_ERROR": 400,
    "CONFIG_MISSING_FIELD": 400,
    "CONFIG_INVALID": 400,
    "CONFIG_INVALID_VALUE": 400,
    "DATA_DIR_MISSING": 422,
    "DATA_MISSING": 422,
    "DATA_NO_CSV": 422,
    "DATA_EMPTY": 422,
    "DATA_COLUMN_MISSING": 422,
    "PREPROCESS_COLUMN_MISSING": 422,
    "PREPROCESS_CONFIG_INVALID": 422,
    "ANON_INFEASIBLE": 422,
    "ANON_NO_QIS": 422,
    "GENERALIZATION_FAILED": 422,
    "IO_READ_FAILED": 500,
    "IO_WRITE_FAILED": 500,
    "IO_PERMISSION_DENIED": 500,
    "INTERNAL_ERROR": 500,
}

# What made this engine raise the code; the error's details name the value, column or file.
HINTS: dict[str, str] = {
    "CONFIG_NOT_FOUND": "find_config saw no file ending in .json in the folder that the details name.",
    "CONFIG_PARSE_ERROR": "Python's JSON reader stopped at the line and column in the details.",
    "CONFIG_MISSING_FIELD": "The file's data_type must be a string, and a key of that name must hold the settings as an object.",
    "CONFIG_INVALID": "A categorical column needs a Hierarchy: one of the built-in names, or one's own passed to Anonymizer.",
    "CONFIG_INVALID_VALUE": "lattice.check takes k from 1 and a suppression_limit between 0 and 1, both ends included.",
    "DATA_DIR_MISSING": "run() reads its table from the folder data beside config.",
    "DATA_MISSING": "Several tables lie in data; run() takes one, the functions of sources.tables any.",
    "DATA_NO_CSV": "Every .csv file in data is empty, or there is none.",
    "DATA_EMPTY": "In each row some quasi-identifier is null, blank or, where a number is due, text; Qi columns can be looked at with histogram.binned.",
    "DATA_COLUMN_MISSING": "Compare the quasi-identifier's name with df.columns; only the endings _scaled and _encoded are overlooked.",
    "PREPROCESS_COLUMN_MISSING": "A transform runs after suppress has dropped its columns; the details name the column that it did not find.",
    "PREPROCESS_CONFIG_INVALID": "The parse method of the transform's class in veilframe.config tells which keys and types an entry has.",
    "ANON_INFEASIBLE": "Even the coarsest node of lattice.levels leaves too many rows in classes below k, or estimates more classes than max_equivalence_classes.",
    "ANON_NO_QIS": "Config.numerical and Config.categorical are both empty.",
    "GENERALIZATION_FAILED": "Each numeric column needs an entry in Config.size, and a node one level for each quasi-identifier.",
    "IO_READ_FAILED": "The operating system's answer is in the details.",
    "IO_WRITE_FAILED": "The operating system's answer is in the details; what was written so far was taken back.",
    "IO_PERMISSION_DENIED": "The user that runs Spark's driver has no right to the path in the details.",
    "INTERNAL_ERROR": "The traceback is in the log file that the status names.",
}


def http_status(code: str) -> int:
    return HTTP_STATUS.get(code, 500)


def hint(code: str) -> str:
    return HINTS.get(code, "See the message and the details.")


class PipelineError(Exception):
    def __init__(self, code: str, message: str, details: str = "") -> None:
        super().__init__(f"{code}: {message}" + (f" ({details})" if details else ""))
        self.code, self.message, self.details = code, message, details

    def payload(self) -> dict[str, object]:
        return {"code": self.code, "message": self.message, "details": self.details, "suggested_fix": hint(self.code), "http_status_code": http_status(self.code)}


def from_os_error(e: OSError, writing: bool = False) -> PipelineError:
    """An operating-system error as a pipeline error, by its kind."""
    if isinstance(e, PermissionError):
        code = "IO_PERMISSION_DENIED"
    elif writing and not isinstance(e, FileNotFoundError):
        code = "IO_WRITE_FAILED"
    else:
        code = "IO_READ_FAILED"
    return PipelineError(code, "A file could not be written" if writing else "A file could not be read", str(e))


def require(found: list[str], names: list[str], code: str = "PREPROCESS_COLUMN_MISSING") -> None:
    for name in names:
        if name not in found:
            raise PipelineError(code, f"Column '{name}' is not in the input", name)
