"""Repository owner and short name."""

from pyspark.sql import DataFrame

from eventpulse.functions import repo_owner, repo_short_name


def enrich_repo(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"repo_owner": repo_owner("repo_name"), "repo_short_name": repo_short_name("repo_name")}
    )
