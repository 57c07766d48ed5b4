"""Plain helpers of the tests: the schema of cells and rows for comparison."""

CELLS = "workbook string, sheet string, r int, c int, value string, kind string"


def tuples(df, *order):
    """Rows as plain tuples, sorted, for comparison."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
