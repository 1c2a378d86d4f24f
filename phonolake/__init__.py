"""phonolake: speech-corpus preparation and token-stream analytics on Spark DataFrames."""
