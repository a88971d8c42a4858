"""Training-data operators over corpora held in DataFrames; nothing else in the package imports this one."""
