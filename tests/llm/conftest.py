import pytest


@pytest.fixture(scope="session")
def tagger(spark, sf):
    """The tagger of personal data, trained with production parameters."""
    from auditloom.llm import pii

    return pii.fit(spark.read.parquet(f"{sf}/documents.parquet"))
