"""Comparison of a Spark result with the result of its SQL twin, order aside."""

from __future__ import annotations


def ordered(names, rows):
    """Rows with columns in name order, sorted; values are compared exactly."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


def spark_rows(frame):
    return sorted(frame.columns), ordered(frame.columns, [tuple(row) for row in frame.collect()])


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return sorted(names), ordered(names, result.fetchall())


SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def spark_types(frame):
    return {field.name: SAME_TYPE[field.dataType.simpleString()] for field in frame.schema}


def duck_types(connection, sql):
    return {row[0]: row[1] for row in connection.execute(f"describe {sql}").fetchall()}
