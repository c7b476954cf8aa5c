"""Column expressions: names, dates, maths, arrays, grids and projections."""
