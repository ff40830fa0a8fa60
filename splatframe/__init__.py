"""splatframe: 3D Gaussian point clouds as Spark DataFrames."""
