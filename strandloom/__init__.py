"""Long-read single-cell transcriptomics tables on Spark DataFrames."""
