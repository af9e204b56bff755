def docs_of(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
