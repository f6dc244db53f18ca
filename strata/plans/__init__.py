"""Plans built from the operators: the SQL face, the RDD face, face comparison and the
end-to-end medallion pipeline."""
