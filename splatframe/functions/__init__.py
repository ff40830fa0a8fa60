"""Column expressions: decoding, encoding and conversion kernels, all inside whole-stage code generation."""
