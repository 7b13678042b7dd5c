"""What several test modules use."""


def by_doc(df, column):
    """{doc_id: value}."""
    return {r["doc_id"]: r[column] for r in df.select("doc_id", column).collect()}
