"""seqframe: labelled sequence collections to model-ready tables, as Spark DataFrames."""
