"""Helper of the tests: small frames as dictionaries."""


def rows_by_key(df, key="account_id"):
    """{key: {column: value}} of a small frame."""
    out = {}
    for row in df.collect():
        assert row[key] not in out, f"two rows for {row[key]}"
        out[row[key]] = row.asDict()
    return out
