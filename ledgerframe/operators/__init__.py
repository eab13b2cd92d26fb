"""Planning and analysis operators: DataFrames in, one lazy DataFrame out."""
